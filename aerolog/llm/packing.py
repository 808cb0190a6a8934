"""Mixture-controlled packing: deficit round-robin over the queues of sources fills windows of tokens.

Documents become token ids with an end id and wait in one queue for each source, in the order of a hash.
In every round each queue is given its quantum, its share of a window (``targets``; by default its share
of all tokens, the one mixture that every window can have if all tokens are packed once). A queue sends
what its quanta allow so far and carries the rest, its deficit, on: fractions of a token from window to
window, and a queue whose quantum is below ``LEAST`` saves until it can send a packet of ``LEAST``
tokens. Queues begin with a deficit drawn from the name of their source, so that small ones don't send
at once. A queue that runs dry drops out, and the others go on in their proportions.

What a queue has sent after r rounds depends on r, its quantum and its first deficit alone, so each
packet's round is known without serving the earlier ones: rounds are dealt to tasks in ``BLOCKS`` equal
ranges, and no deficit is lost between them. Packets by (round, source, place in the queue) are one
stream, which is cut every ``size`` tokens; documents are cut where packets or windows end. All windows
are full but what is left at the end, less than a window: it is cut at powers of two, the largest
first, so that nothing is padded at all.

A null or empty text is the end id alone. Null sources are a queue of their own, null ids of documents
come first. Rows with one id are told apart by their ids' hash; equal ones are interchangeable, and
many of them are spread by their place in the written token table. An empty table gives no pieces. Other columns don't
matter. Sources without a target keep their share of all tokens, and the others divide the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolog.llm.bpe import lists, vocabulary
from aerolog.llm.common import ready_for_python, small, small_batches
from aerolog.llm.token_files import encoded, width
from aerolog.session import materialized

SIZE = 4096
#: The fewest tokens that a queue sends at once, but for its last.
LEAST = 64
#: Parts of each queue, and ranges of rounds.
BUCKETS, BLOCKS = 4096, 4096
#: Rows of one id and text from which on they are spread.
COPIES = 4096


def share(queue: Column, total: Column, all_tokens: int, targets: dict[str | None, float] | None) -> Column:
    """The part of a window that a queue is to fill."""
    natural = total / F.lit(float(all_tokens))
    if not targets:
        return natural
    given = F.create_map(*(F.lit(x) for name, part in targets.items() for x in (name_of(name), float(part))))
    return F.coalesce(F.get(F.map_values(F.map_filter(given, lambda k, _: k == queue)), F.lit(0)), natural)


def name_of(source: str | None) -> str:
    return "-" if source is None else f"+{source}"


def packets(docs: DataFrame, path: str, end: int, size: int = SIZE, key: str = "doc_id", source: str = "source", text: str = "text",
            targets: dict[str | None, float] | None = None) -> tuple[DataFrame, DataFrame, int, str]:
    """Packets (lot, doc_id, queue, at, n, start, length, round, block), the token table (lot, ids), the number of all tokens, and the numpy type of an id.

    ``lot`` numbers the rows of the written token table. Packets are planned without the ids.
    """
    if targets and min(targets.values()) <= 0:
        raise ValueError("targets must be above 0")
    spark = docs.sparkSession
    ready_for_python(spark)
    shared = vocabulary(spark, path)
    kind = width(shared.value, end)
    bytes_ = np.dtype(kind).itemsize
    queue = F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source)))
    tokens = (docs.select(F.col(key).cast("long").alias("doc_id"), queue.alias("queue"), encoded(F.col(text), shared, end, kind).alias("ids"))
              .select("doc_id", "queue", "ids", (F.octet_length("ids") / bytes_).cast("long").alias("n"),
                      F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("lot")))
    with small_batches(spark):
        tokens = materialized(tokens)
    many = materialized(tokens.groupBy("queue", "doc_id", "tie").count().where(F.col("count") >= COPIES)
                        .select(F.xxhash64("queue", "doc_id", "tie").alias("same"), F.lit(True).alias("spread")).distinct())
    rows = (tokens.drop("ids").withColumn("same", F.xxhash64("queue", "doc_id", "tie")).join(many, "same", "left")
            .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie", F.when(F.col("spread"), F.col("lot") % BUCKETS).otherwise(F.lit(0))), F.lit(BUCKETS))))

    so_far = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("queue")
    # at most BUCKETS rows for each source
    sums = materialized(rows.groupBy("queue", "bucket").agg(F.sum("n").alias("n"))
                        .select("queue", "bucket", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("first"), F.sum("n").over(whole).alias("total"), "n"))
    found = sums.agg(F.sum("n")).first()[0] or 0
    parts = sums.select("queue", "total").distinct().withColumn("share", share(F.col("queue"), F.col("total"), max(found, 1), targets))
    if targets:
        # shares of all sources make one window: those without a target keep theirs, the others divide the rest
        free = F.col("queue").isin([name_of(t) for t in targets])
        kept, asked = parts.agg(F.sum(F.when(~free, F.col("share"))), F.sum(F.when(free, F.col("share")))).first()
        parts = parts.withColumn("share", F.when(free, F.col("share") * ((1 - (kept or 0.0)) / (asked or 1.0))).otherwise(F.col("share")))
    quantum = F.col("share") * size
    parts = parts.select("queue", quantum.alias("quantum"), F.greatest(quantum, F.lit(float(LEAST))).alias("step"),
                         (F.shiftrightunsigned(F.xxhash64("queue"), 11) / F.lit(float(1 << 53))).alias("phase"))
    sums = sums.select("queue", "bucket", "first").join(parts, "queue")

    earlier = Window.partitionBy("queue", "bucket").orderBy("doc_id", "tie", "lot").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(sums, ["queue", "bucket"])
    at = F.col("first") + F.col("before")
    placed = placed.select("lot", "doc_id", "queue", "n", at.alias("own"), "quantum", "step", "phase")
    # packet k of a queue holds its tokens from floor(k * step) to floor((k + 1) * step); one more at either end stays empty
    k = F.col("k").cast("double")
    low, high = F.floor(k * F.col("step")), F.floor((k + 1) * F.col("step"))
    cut = (placed.select("*", F.explode(F.sequence(F.greatest(F.floor(F.col("own") / F.col("step")) - 1, F.lit(0)), F.floor((F.col("own") + F.col("n")) / F.col("step")) + 1)).alias("k"))
           .withColumn("from", F.greatest("own", low)).withColumn("to", F.least(F.col("own") + F.col("n"), high)).where("`from` < `to`"))
    rounds = max(1, -(-found // size))
    last = F.lit(rounds - 1) if not targets else F.lit((1 << 53) - 1)
    round_ = F.least(F.floor((k + F.col("phase")) * F.col("step") / F.col("quantum")), last)
    # without a bound on rounds (queues run dry at different times), a block is a range of rounds of the same width
    block = F.least(F.floor(F.col("round") * BLOCKS / rounds), F.lit((1 << 31) - 1)).cast("int")
    start = F.col("from") - F.col("own")
    out = (cut.withColumn("round", round_)
           .select("lot", "doc_id", "queue", F.col("from").alias("at"), "n", start.alias("start"), (F.col("to") - F.col("from")).alias("length"), "round", block.alias("block")))
    return out, tokens.select("lot", "ids"), found, kind


def tail_cuts(total: int, size: int) -> list[int]:
    """Where the sequences behind the full windows begin, and the end of all: powers of two, the largest first."""
    cuts = [total // size * size]
    for bit in reversed(range(size.bit_length())):
        if total % size >> bit & 1:
            cuts.append(cuts[-1] + (1 << bit))
    return cuts


def packed(docs: DataFrame, path: str, end: int, size: int = SIZE, key: str = "doc_id", source: str = "source", text: str = "text",
           targets: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces (doc_id, source, start, length, doc_tokens, round, sequence_id, offset, ids); ``ids`` holds little-endian unsigned integers of two bytes, or four where the vocabulary needs them."""
    cut, tokens, total, kind = packets(docs, path, end, size, key, source, text, targets)
    bytes_ = np.dtype(kind).itemsize
    blocks = cut.groupBy("block").agg(F.sum("length").alias("sum"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = blocks.select("block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("block").orderBy("round", "queue", "at").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("before", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(firsts, "block")
    place, stop = F.col("place"), F.col("place") + F.col("length")
    full, tail = total // size * size, tail_cuts(total, size)
    windows = F.sequence((F.floor(place / size) + 1) * size, F.greatest(stop, (F.floor(place / size) + 1) * size), F.lit(size).cast("long"))
    cuts = F.filter(F.concat(F.filter(windows, lambda x: x <= full), F.array(*(F.lit(c).cast("long") for c in tail[1:])).cast("array<bigint>")), lambda x: (x > place) & (x < stop))
    tails = F.array(*(F.lit(c).cast("long") for c in tail))
    split = (placed.withColumn("place", F.col("first") + F.col("before")).withColumn("cuts", F.concat(F.array(place), cuts, F.array(stop)))
             .select("*", F.explode(F.sequence(F.lit(0), F.size("cuts") - 2)).alias("c"))
             .withColumn("a", F.get("cuts", F.col("c"))).withColumn("b", F.get("cuts", F.col("c") + 1)))
    a, skipped = F.col("a"), F.col("a") - F.col("place")
    begun = F.size(F.filter(tails, lambda x: x <= a))  # sequences behind the windows that began
    sequence = F.when(a < full, F.floor(a / size)).otherwise(F.lit(full // size) + begun - 1)
    offset = F.when(a < full, a % size).otherwise(a - F.get(tails, begun - 1))
    # the ids move once, to the pieces of their row
    from_, length = F.col("start") + skipped, F.col("b") - a
    placed = split.select("lot", "doc_id", "queue", from_.alias("start"), length.alias("length"), "n", "round", sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    return placed.join(tokens, "lot").select(
        "doc_id", F.when(F.col("queue") != "-", F.substring("queue", 2, (1 << 31) - 1)).alias("source"), "start", "length", F.col("n").alias("doc_tokens"), "round",
        "sequence_id", "offset", F.substring(F.col("ids"), (F.col("start") * bytes_ + 1).cast("int"), (F.col("length") * bytes_).cast("int")).alias("ids"))


def ids_crc32(ids: Column, kind: str) -> Column:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    @F.arrow_udf("long")
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in small(batches):
            yield pa.array([zlib.crc32(np.frombuffer(r, kind).astype("<u4")) for r in rows.to_pylist()], pa.int64())

    return crc(ids)


def sequences(pieces: DataFrame, kind: str = "<u2") -> DataFrame:
    """One row for each sequence: its ids, and (doc_id, source, start, length) of its pieces in order.

    A sequence is of a window's size at most, so its pieces are a bounded group.
    """
    @F.arrow_udf("array<int>")
    def array(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in small(batches):
            yield lists([np.frombuffer(r, kind).astype(np.int32) for r in rows.to_pylist()])

    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "source", "start", "length", "ids"))).alias("p"))
    bytes_ = F.aggregate("p", F.lit(b"").cast("binary"), lambda made, x: F.concat(made, x["ids"]))
    return whole.select("sequence_id", array(bytes_).alias("ids"),
                        F.transform("p", lambda x: F.struct(x["doc_id"], x["source"], x["start"], x["length"])).alias("pieces"))
