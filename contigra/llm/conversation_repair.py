"""Conversation repair: the cheapest edits that give each conversation legal roles.

Rows get a place in their conversation by ``numbered_within`` (by turn, nulls first, then role, then text, which also keeps repeats
together), and windows give each row its fault.  Sorted structs of one letter and one fault a row, never texts, are collected by
CHUNK rows, and ``aggregate`` folds them: it carries the cheapest (cost, audit) that ends in each of four states, nothing kept
yet, after system, after user and after assistant, and ``least`` of these structs is the cheapest, then the least audit.
Each chunk is folded from every state that it may begin in, and a second fold joins the chunks of a conversation, so the audit of
a long one isn't copied once a row.  One insertion between two rows is enough: two in a row lead to no state that is not
reached without them for less.

The fold also carries, row by row, what is inserted before it and what becomes of it.  These letters meet the rows again by chunk, and
the lines of a conversation stream through its hash in order, sorted on disk; SHA-256 can't be split, but it holds no text.

Defined cases: a null conversation is one conversation; null ids and turns count as one space in the checksum that deals out the
damage, null roles and texts are one space in all that follows; roles other than system, user and assistant go by their first letter;
equal rows of one turn stand next to each other, and all but the first are duplicates; a conversation of which no row is left has zeros,
an empty audit and the hash of the empty text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, write_shared
from contigra.operators.windows import numbered_within

CHUNK = 512
STATES = ("e", "s", "u", "a")  # nothing kept, after system, after user, after assistant
NEVER = 1 << 50
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """c_, turn, role, text: the rows after a damage that the checksum of conversation and turn deals out."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = conversations.select(text_of("conv_id").alias("c_"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"))
    own = own.withColumn("kind_", F.crc32(F.concat("c_", F.lit(":"), text_of("turn")).cast("binary")) % 20).where("kind_ <> 0")
    text = F.when(F.col("kind_") == 1, "").when(F.col("kind_") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind_") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind_") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("c_", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy_"))


def placed(rows: DataFrame) -> DataFrame:
    """c_, turn, role, text, n (from 1 by conversation), written.  However many rows a conversation has, ranges of them are sorted."""
    near = rows.withColumn("head_", F.substring("text", 1, 32))
    out = numbered_within(near, ["c_"], ["turn", "role", "text", "copy_"], "n", deal=["turn", "role", "head_"])
    return write_shared(out.select("c_", "turn", "role", "text", "n"), "repair-rows")


def faults(rows: DataFrame) -> DataFrame:
    """c_, n, turn, letter, fault of placed rows: the first of blank, duplicate and truncated, or none."""
    seen = F.sha2(F.concat_ws(":", "c_", F.length("role").cast("string"), "role", "text"), 256)
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    own = rows.select("c_", "n", "turn", F.substring("role", 1, 1).alias("letter"), seen.alias("seen_"), (end == "").alias("blank_"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut_"))
    first = own.groupBy("seen_").agg(F.min("n").alias("first_"))
    fault = F.when(F.col("blank_"), "b").when(F.col("n") > F.col("first_"), "d").when(F.col("cut_"), "t").otherwise("")
    return own.join(first, "seen_").select("c_", "n", "turn", "letter", fault.alias("fault"))


def _then(state: Column, cost: Column | int, audit: str, plan: str | Column) -> Column:
    plan = F.lit(plan) if isinstance(plan, str) else plan
    return F.struct((state["cost"] + cost).cast("long").alias("cost"), F.concat(state["audit"], F.lit(audit)).alias("audit"), F.concat(state["plan"], plan).alias("plan"))


def _start(at: str) -> Column:
    one = lambda s: F.struct(F.lit(0 if s == at else NEVER).cast("long").alias("cost"), F.lit("").alias("audit"), F.lit("").alias("plan"))
    return F.struct(*[one(s).alias(s) for s in STATES])


def _row(state: Column, row: Column) -> Column:
    """The four states after one more row: perhaps an insertion, then Delete, Keep or Rerole."""
    e, s = (_then(state[x], 0, "", "-") for x in ("e", "s"))
    u = F.least(_then(state["u"], 0, "", "-"), *[_then(state[x], INSERT, "I", "u") for x in ("e", "s", "a")])
    a = F.least(_then(state["a"], 0, "", "-"), _then(state["u"], INSERT, "I", "a"))
    gone = lambda x: _then(x, DELETE, "D", "-")
    whole = ~row["fault"].isin("b", "d")
    more = F.when(row["fault"] == "t", TRUNCATED).otherwise(0)

    def taken(x: Column, letter: str) -> Column:
        """Kept as it is, or with another role; null where it must go."""
        return F.when(whole & (row["letter"] == letter), _then(x, more, "K", "k")).when(whole, _then(x, more + REROLE, "R", letter))

    kept = F.when(whole & (row["letter"] == "s"), _then(e, more, "K", "k"))
    return F.struct(gone(e).alias("e"), F.least(gone(s), kept).alias("s"), F.least(gone(u), *[taken(x, "u") for x in (e, s, a)]).alias("u"), F.least(gone(a), taken(u, "a")).alias("a"))


def _chunks(state: Column, chunk: Column) -> Column:
    """The four states after a chunk that has been folded from each state."""

    def joined(x: str, y: str) -> Column:
        was, own = state[x], chunk[x][y]
        return F.struct((was["cost"] + own["cost"]).alias("cost"), F.concat(was["audit"], own["audit"]).alias("audit"), F.concat(was["plan"], own["plan"]).alias("plan"))

    return F.struct(*[F.least(*[joined(x, y) for x in STATES]).alias(y) for y in STATES])


def folded(marked: DataFrame) -> DataFrame:
    """One row a conversation: rows, gaps, blank, duplicate, truncated, illegal, cost, audit, plan."""
    k = F.floor((F.col("n") - 1) / CHUNK)
    own = marked.withColumn("k_", F.when(F.col("n") % CHUNK == 0, F.array(k, k + 1)).otherwise(F.array(k)))
    own = own.withColumn("k_", F.explode("k_"))  # the last row of a chunk is before the first of the next
    w = Window.partitionBy("c_", "k_").orderBy("n")
    own = own.withColumns({"before_": F.lag("letter").over(w), "turn_": F.lag("turn").over(w)}).where(F.col("k_") == k)
    illegal = F.col("before_").isNotNull() & ~F.concat("before_", "letter").isin("su", "ua", "au")
    counts = [F.count_if(F.col("fault") == x[0]).alias(x) for x in ("blank", "duplicate", "truncated")] + [F.count_if(illegal).alias("illegal"), F.count(F.lit(1)).alias("rows")]
    turns = [F.count_if(F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_"))).alias("turns"), F.min("turn").alias("low"), F.max("turn").alias("high")]
    sums = ["blank", "duplicate", "truncated", "illegal", "rows", "turns"]
    parts = own.groupBy("c_", "k_").agg(F.sort_array(F.collect_list(F.struct("n", "letter", "fault"))).alias("own_"), *counts, *turns)
    ends = [F.when((F.col("k_") > 0) | F.lit(x == "e"), F.aggregate("own_", _start(x), _row)).otherwise(_start(x)).alias(x) for x in STATES]
    parts = parts.select("c_", *sums, "low", "high", F.struct("k_", *ends).alias("part_"))
    all_ = parts.groupBy("c_").agg(F.sort_array(F.collect_list(F.struct(F.col("part_.k_").alias("k_"), "part_"))).alias("parts_"), *[F.sum(x).alias(x) for x in sums], F.min("low").alias("low"), F.max("high").alias("high"))
    all_ = all_.withColumn("s_", F.aggregate("parts_", _start("e"), lambda state, p: _chunks(state, p["part_"])))
    s = F.col("s_")
    best = F.least(_then(s["e"], 0, "", "-"), _then(s["a"], 0, "", "-"), _then(s["u"], INSERT, "I", "a"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return all_.withColumn("best_", best).select("c_", "rows", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "best_.cost", "best_.audit", "best_.plan")


def lines(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """c_, n, line: the repaired conversation in order; inserted rows stand with the row after them."""
    width = 2 * CHUNK
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / CHUNK)))
    pieces = plans.select("c_", "plan", at.alias("k_")).select("c_", "k_", F.expr(f"substring(plan, cast(k_ * {width} + 1 as int), {width})").alias("piece_"))
    own = rows.select("c_", "n", "role", "text", F.floor((F.col("n") - 1) / CHUNK).alias("k_")).join(pieces, ["c_", "k_"])
    letter = lambda i: F.expr(f"substring(piece_, cast(2 * ((n - 1) % {CHUNK}) + {i} as int), 1)")
    own = own.withColumns({"in_": letter(1), "as_": letter(2)}).where("in_ <> '-' or as_ <> '-'")
    name = lambda c: F.when(F.col(c) == "u", "user").when(F.col(c) == "a", "assistant")
    before = F.concat(name("in_"), F.lit(":"))
    itself = F.concat(F.when(F.col("as_") == "k", F.col("role")).otherwise(name("as_")), F.lit(":"), "text")
    last = plans.where(F.expr("substring(plan, cast(2 * rows + 1 as int), 1)") == "a").select("c_", (F.col("rows") + 1).alias("n"), F.lit("assistant:").alias("line"))
    return own.select("c_", "n", F.concat_ws("\n", before, itself).alias("line")).union(last)


def digests(rows: DataFrame) -> DataFrame:
    """c_, repaired_sha256 of lines (c_, n, line), joined by newlines in order; a conversation's lines stream by, none is held."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, h, done = None, None, []
        out = lambda found: pa.RecordBatch.from_pylist(found, pa.schema([("c_", pa.string()), ("repaired_sha256", pa.string())]))
        for batch in batches:
            for name, line in zip(batch.column(0).to_pylist(), column_bytes(batch, "line"), strict=True):
                if name != last:
                    if h:
                        done.append({"c_": last, "repaired_sha256": h.hexdigest()})
                    last, h = name, hashlib.sha256(line)
                else:
                    h.update(b"\n")
                    h.update(line)
            yield out(done)
            done = []
        yield out([{"c_": last, "repaired_sha256": h.hexdigest()}] if h else [])

    return rows.repartition("c_").sortWithinPartitions("c_", "n").select("c_", "line").mapInArrow(run, "c_ string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row a conversation."""
    rows = placed(damaged(conversations))
    plans = write_shared(folded(faults(rows)), "repair-plans")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("c_", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    found = ids.join(plans.drop("plan", "rows"), "c_", "left").join(digests(lines(rows, plans)), "c_", "left")
    zero = [F.coalesce(x, F.lit(0)).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
