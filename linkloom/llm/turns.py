"""Repair of conversations whose turns are lost, blank, repeated, cut off or out of order.

Rows are put in order by a range sort, so that a conversation of any length is spread
over tasks, and cut into pieces of at most 256 rows. Windows derive each row's fault;
the sorted rows of a piece are folded by ``aggregate()``, which carries the cheapest
(cost, plan) of four states: nothing said yet, a system turn, a user turn, an answer.
A piece that may begin inside a conversation is folded from each of the four, and the
pieces of a conversation are joined by the least sums over the states between them.

A plan has a letter for each edit: D delete, I and J insert a user or an assistant turn,
K keep, R and S give a row the role of user or assistant. Inserts stand before the row
that they precede, so that every row is ``[IJ]*[DKRS]``. Within one state two different
plans of equal cost and length of rows first differ in the kind of edit, so that the
order of plans is that of audits, where J is I and S is R.

Null roles and texts are one space; a null conv_id is a conversation, and a null turn comes
before the others. Rows of one turn stand in the order of role, the text's first 64
characters and its digest; equal rows are interchangeable. A text or role may be of any length;
other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace, batch_rows, lean

PIECE_BITS, PART_BITS = 8, 33
#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The cost of what cannot be reached.
NEVER = 1 << 40
BLANK = " \t\n\x0b\x0c\r"
STATES = ("e", "s", "u", "a")
STRUCT = "struct<cost:bigint,plan:string>"
ROW = F.element_at


def key_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit(":"), conv_id.cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with made faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    end marks, 3 repeats it, 4 makes it the user's. A null is one space, in the key too."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered(ws: Workspace, rows: DataFrame) -> DataFrame:
    """``rows`` written in order: c (the conversation's key), at (rows of a conversation follow each other in it), turn, role,
    text, initial, k (digest of role and text), blank, truncated."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    plain = rows.select(key_of(F.col("conv_id")).alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256), 1, 32))
    told = F.expr(f"trim(TRAILING '{BLANK}' FROM text)")
    wide = plain.withColumn("k", digest).withColumn("_end", F.right(told, F.lit(1))).withColumn("_any", F.monotonically_increasing_id())
    order = [F.col("c"), F.asc_nulls_first("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64), F.col("k"), F.col("_any")]
    sorted_rows = wide.repartitionByRange(*order).sortWithinPartitions(*order)
    return ws.table(sorted_rows.select("c", F.monotonically_increasing_id().alias("at"), "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), "k", (F.col("_end") == "").alias("blank"), (~F.col("_end").isin(".", "!", "?")).alias("truncated")), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """c, at, turn, initial and one fault at most of each row: blank, duplicate or truncated.

    A row's equals are looked for among the rows of its partition first; of those only the first meets the other partitions'.
    """
    rows = turns.select("c", "at", "turn", "initial", "k", "blank", "truncated", F.shiftright("at", PART_BITS).alias("part"))
    here = F.row_number().over(Window.partitionBy("c", "part", "k").orderBy("at")) > 1
    rows = rows.withColumn("here", here)
    first = F.min("part").over(Window.partitionBy("c", "k", F.when(F.col("here"), F.col("at"))))
    rows = rows.withColumn("again", F.col("here") | (F.col("part") > first))
    return rows.select("c", "at", "turn", "initial", "blank", (~F.col("blank") & F.col("again")).alias("duplicate"), (~F.col("blank") & ~F.col("again") & F.col("truncated")).alias("truncated"))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _and(state: Column, cost, letter: str) -> Column:
    return F.struct((state["cost"] + cost).alias("cost"), F.concat(state["plan"], F.lit(letter)).alias("plan"))


def _with_inserts(state: Column) -> Column:
    """The four states, where turns may have been inserted at the end."""
    user = F.least(state["u"], _and(F.least(state["e"], state["s"], state["a"]), INSERT, "I"))
    return _bound(user, lambda u: F.struct(state["e"].alias("e"), state["s"].alias("s"), u.alias("u"), F.least(state["a"], _and(u, INSERT, "J")).alias("a")))


def _step(state: Column, row: Column) -> Column:
    """The four states after a row."""

    def edits(z: Column) -> Column:
        before, stays, kept = F.least(z["e"], z["s"], z["a"]), ~row["must"], row["initial"]
        late = F.when(row["truncated"], F.lit(TRUNCATED)).otherwise(F.lit(0))
        return F.struct(
            _and(z["e"], DELETE, "D").alias("e"),
            F.least(_and(z["s"], DELETE, "D"), F.when(stays & (kept == "s"), _and(z["e"], late, "K"))).alias("s"),
            F.least(_and(z["u"], DELETE, "D"), F.when(stays & (kept == "u"), _and(before, late, "K")), F.when(stays, _and(before, late + REROLE, "R"))).alias("u"),
            F.least(_and(z["a"], DELETE, "D"), F.when(stays & (kept == "a"), _and(z["u"], late, "K")), F.when(stays, _and(z["u"], late + REROLE, "S"))).alias("a"),
        )

    return _bound(_with_inserts(state), edits)


def _start(at: Column) -> Column:
    """The states before the first row: only the state number ``at`` is possible."""
    return F.struct(*(F.struct(F.when(at == i, F.lit(0)).otherwise(F.lit(NEVER)).cast("long").alias("cost"), F.lit("").alias("plan")).alias(s) for i, s in enumerate(STATES)))


def _through(state: Column, table: Column) -> Column:
    """The states after a piece whose four folds are ``table``."""
    step = lambda i, to: F.struct((state[STATES[i]]["cost"] + ROW(table, i + 1)[to]["cost"]).alias("cost"), F.concat(state[STATES[i]]["plan"], ROW(table, i + 1)[to]["plan"]).alias("plan"))
    return F.struct(*(F.least(*(step(i, to) for i in range(4))).alias(to) for to in STATES))


def _illegal(left: Column, right: Column) -> Column:
    return (~F.concat(left, right).isin("su", "ua", "au")).cast("long")


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _joined(left: Column, right: Column) -> Column:
    """The summary of two neighbouring pieces of a conversation."""
    total = {c: left[c] + right[c] for c in COUNTS}
    total["illegal"] += _illegal(left["tail"], right["head"])
    total["turns"] -= F.coalesce((left["last"] == right["first"]).cast("long"), F.lit(0))
    named = [total[c].alias(c) for c in COUNTS] + [F.least(left["lo"], right["lo"]).alias("lo"), F.greatest(left["hi"], right["hi"]).alias("hi")]
    named += [left[c].alias(c) for c in ("first", "head")] + [right[c].alias(c) for c in ("last", "tail")]
    return F.struct(*named, F.transform(left["m"], lambda row: _through(row, right["m"])).alias("m"))


def _folded(pieces: Column) -> Column:
    return F.aggregate(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), ROW(pieces, 1)["sum"], lambda acc, x: _joined(acc, x["sum"]))


def pieces(flagged: DataFrame) -> DataFrame:
    """A row for each piece: c, piece, lead (its first at), n (rows) and sum, its counts, ends and folds."""
    rows = flagged.withColumn("piece", F.shiftright("at", PIECE_BITS)).groupBy("c", "piece").agg(
        F.array_sort(F.collect_list(F.struct("at", "turn", "initial", (F.col("blank") | F.col("duplicate")).alias("must"), "truncated"))).alias("rows"),
        *(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.min("turn").alias("lo"),
        F.max("turn").alias("hi"),
    )
    rows = rows.withColumn("lead", ROW("rows", 1)["at"]).withColumn("n", F.size("rows"))
    n, given = F.col("n"), F.filter(F.transform("rows", lambda x: x["turn"]), lambda t: t.isNotNull())
    pairs = F.zip_with(F.slice("rows", F.lit(1), n - 1), F.slice("rows", F.lit(2), n - 1), lambda x, y: _illegal(x["initial"], y["initial"]))
    # Only a piece whose first row is the first of 256 can begin inside a conversation.
    inside = F.col("lead").bitwiseAND((1 << PIECE_BITS) - 1) == 0
    starts = F.when(inside, F.array(*(F.lit(i) for i in range(4)))).otherwise(F.array(F.lit(0)))
    folds = F.transform(starts, lambda s: F.aggregate("rows", _start(s), _step))
    ends = [ROW("rows", 1)["turn"].alias("first"), ROW("rows", 1)["initial"].alias("head"), ROW("rows", -1)["turn"].alias("last"), ROW("rows", -1)["initial"].alias("tail")]
    counts = ["blank", "duplicate", "truncated", F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x).alias("illegal"), F.size(F.array_distinct(given)).cast("long").alias("turns")]
    return rows.select("c", "piece", "lead", "n", F.struct(*counts, "lo", "hi", *ends, folds.alias("m")).alias("sum"))


def _cut(plan: Column, parts: Column) -> Column:
    """``plan`` cut into the letters of each piece and, last, the turns inserted at the end."""
    zero = F.struct(plan.alias("rest"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        own = F.regexp_substr(acc["rest"], F.concat(F.lit("^(?:[IJ]*[DKRS]){"), part["n"].cast("string"), F.lit("}")))
        return _bound(own, lambda x: F.struct(F.substring(acc["rest"], F.length(x) + 1, F.length(acc["rest"])).alias("rest"), F.concat(acc["out"], F.array(x)).alias("out")))

    return F.aggregate(parts, zero, step)


def plans(folded: DataFrame) -> DataFrame:
    """A row for each conversation with rows: c, the counts, cost, audit, cut (piece, lead and letters of each piece), tail."""
    by_part = folded.withColumn("part", F.shiftright("piece", PART_BITS - PIECE_BITS)).groupBy("c", "part").agg(F.array_sort(F.collect_list(F.struct("piece", "lead", "n"))).alias("places"), F.array_sort(F.collect_list(F.struct("piece", "sum"))).alias("list"))
    by_part = by_part.select("c", "part", "places", _folded(F.col("list")).alias("sum"))
    whole = by_part.groupBy("c").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "places"))), lambda x: x["places"])).alias("places"), F.array_sort(F.collect_list(F.struct("part", "sum"))).alias("list"))
    whole = whole.select("c", "places", _folded(F.col("list")).alias("sum"))
    end = _bound(_with_inserts(ROW(F.col("sum.m"), 1)), lambda z: F.least(z["e"], z["a"]))
    gaps = F.coalesce(F.col("sum.hi") - F.col("sum.lo") + 1 - F.col("sum.turns"), F.lit(0)).alias("gaps")
    out = whole.select("c", gaps, *(F.col(f"sum.{x}").alias(x) for x in COUNTS[:4]), "places", end.alias("end"))
    out = out.withColumn("parts", _cut(F.col("end.plan"), F.col("places")))
    named = F.zip_with("places", F.col("parts.out"), lambda p, x: F.struct(p["piece"].alias("piece"), p["lead"].alias("lead"), x.alias("letters")))
    return out.select("c", "gaps", *COUNTS[:4], F.col("end.cost").alias("cost"), F.translate("end.plan", "JS", "IR").alias("audit"), named.alias("cut"), F.col("parts.rest").alias("tail"))


def _inserted(letters: Column) -> Column:
    """The turns that letters I and J stand for."""
    each = F.filter(F.split(letters, ""), lambda x: x != "")
    return F.transform(each, lambda x: F.struct(F.when(x == "I", F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit("").alias("text"), F.lit("Insert").alias("edit")))


def repaired(turns: DataFrame, planned: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: c, at and place (their order), role, text, edit (Keep, Rerole or Insert)."""
    letters = planned.select("c", F.explode("cut").alias("p")).select("c", F.col("p.piece").alias("piece"), F.col("p.lead").alias("lead"), F.regexp_extract_all("p.letters", F.lit("[IJ]*[DKRS]"), F.lit(0)).alias("tokens"))
    rows = turns.select("c", "at", "role", "text", F.shiftright("at", PIECE_BITS).alias("piece")).join(letters, ["c", "piece"])
    token = ROW("tokens", (F.col("at") - F.col("lead") + 1).cast("int"))
    rows = rows.select("c", "at", "role", "text", F.right(token, F.lit(1)).alias("last"), token.alias("token"))
    role = F.when(F.col("last") == "R", F.lit("user")).when(F.col("last") == "S", F.lit("assistant")).otherwise(F.col("role"))
    edit = F.when(F.col("last") == "K", F.lit("Keep")).otherwise(F.lit("Rerole"))
    own = F.when(F.col("last") != "D", F.array(F.struct(role.alias("role"), F.col("text").alias("text"), edit.alias("edit")))).otherwise(F.array().cast("array<struct<role:string,text:string,edit:string>>"))
    before = _inserted(F.substring(F.col("token"), F.lit(1), F.length("token") - 1))
    at_end = planned.where("tail <> ''").select("c", F.lit((1 << 63) - 1).alias("at"), F.posexplode(_inserted(F.col("tail"))).alias("place", "x"))
    return rows.select("c", "at", F.posexplode(F.concat(before, own)).alias("place", "x")).unionByName(at_end).select("c", "at", "place", "x.role", "x.text", "x.edit")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order to a digest for each conversation, read as a stream: one of any length is never held whole."""
    held, digest = None, None
    one = lambda: pa.RecordBatch.from_arrays([pa.array(done, pa.string()), pa.array(sums, pa.string())], names=["c", "repaired_sha256"])
    done: list[str] = []
    sums: list[str] = []
    for c, role, text in batch_rows(batches):
        if digest is None or c != held:
            if digest is not None:
                done.append(held)
                sums.append(digest.hexdigest())
                if len(done) == 4096:
                    yield one()
                    done, sums = [], []
            held, digest = c, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest is not None:
        done.append(held)
        sums.append(digest.hexdigest())
        yield one()


def digests(lines: DataFrame) -> DataFrame:
    """c and repaired_sha256: the digest of a conversation's ``role:text`` lines. SHA-256 goes through them one after the other,
    so that a conversation is in one task, as a stream."""
    rows = lines.repartition("c").sortWithinPartitions("c", "at", "place").select("c", "role", "text")
    return rows.mapInArrow(lean(_digested), "c string, repaired_sha256 string")


def repair_table(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """What repairing ``rows`` costs and gives, for every conv_id of ``conversations``; one without rows has zeros and nothing."""
    ws = Workspace(conversations.sparkSession, "turns")
    turns = ordered(ws, rows)
    planned = ws.table(plans(pieces(faults(turns))), "plans")
    lines = digests(repaired(turns, planned))
    out = conversations.select("conv_id").distinct().withColumn("c", key_of(F.col("conv_id"))).join(planned.drop("cut", "tail"), "c", "left").join(lines, "c", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS[:4], "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
