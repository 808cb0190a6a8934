"""Weather-station analytics for whole station networks, as Spark DataFrame jobs.

Every function takes and returns DataFrames (or Columns) and is keyed by ``(source, station_id)``
unless told otherwise through ``keys``.  Timestamps are zone-less (``TIMESTAMP_NTZ``) and mean UTC,
so results do not depend on the session time zone.
"""
