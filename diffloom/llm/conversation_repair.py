"""Conversation structure repair: lightest derivations by Knuth's agenda.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles. Its rows are edited to
that form at least cost (``COSTS``), and of the cheapest edits those whose letters, in order, are
the smallest string. This is a derivation in a weighted hypergraph. Its items are

* ``Edit(i, x)``: row ``i`` becomes the role initial ``x`` (or nothing),
* ``Insert(x)``: a message of role ``x`` without text,
* ``Span(p, q, i, j)``: rows ``i`` to ``j`` lead from state ``p`` of the form to state ``q``,
* ``Goal``: all rows lead from the start to an end,

and a deduction joins two items to one, adding up costs and putting audits one behind the other.
The agenda pops items by (cost, rows covered, audit): a deduction's result is never before its
antecedents there, and, as two audits of one item and cost are never one the beginning of the
other, putting the same audit before or behind two of them keeps their order. So each popped item
is final, and the search ends when the wanted items are.

On Spark: the small rows (keys, role, digest of the text, no texts) are sorted by ranges, so that
one long conversation spreads over many tasks, and cut into blocks of at most ``BLOCK`` rows of one
conversation. A block becomes a short string (two letters a row), from which the agenda derives the
spans between all states; spans of neighbouring blocks are joined by the same agenda in rounds,
``FAN`` blocks at a time, each round a group and each group small, until a conversation has one. The audit,
one string for each conversation, is as long as the conversation has rows. ``repaired`` and
``digests`` shuffle the texts once and stream through them, sorted, with the audit of one
conversation in memory: a digest over a whole conversation is one pass by nature.

Nulls in role or text are one space; a null turn comes first; a null conversation is one of its own.
Rows of one turn come by role, then by the MD5 of their text; repeated rows are duplicates. Of an
empty table nothing is returned. Texts of any length are read whole. Further columns are left behind.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom.session import materialize

#: Keep, Rerole, Delete, Insert, and what an undeleted truncated row adds.
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
#: State -> role initial -> state, for ``(s?(ua)+)?``: start, after s, after u, after a.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
#: Rows of a block, and blocks joined at once.
BLOCK = 256
FAN = 16

Value = tuple[int, str]


def lightest(axioms: Iterable[tuple[tuple, Value]], deduce: Callable, size: Callable[[tuple], int],
             wanted: set | None = None) -> dict[tuple, Value]:
    """Knuth's generalisation of shortest paths: the least value of each item, final when popped.

    ``deduce(item, done)`` gives (result, left, right) for each deduction whose antecedents are
    ``item`` and another item of ``done``, either way round. Ends when all ``wanted`` items are
    final, or no item is left.
    """
    agenda = [(cost, size(item), audit, item) for item, (cost, audit) in axioms]
    heapq.heapify(agenda)
    done: dict[tuple, Value] = {}
    best: dict[tuple, Value] = {}
    missing = set(wanted or ())
    while agenda:
        cost, _, audit, item = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = (cost, audit)
        missing.discard(item)
        if wanted and not missing:
            break
        for result, left, right in deduce(item, done):
            if result in done:
                continue
            value = (left[0] + right[0], left[1] + right[1])
            if result not in best or value < best[result]:
                best[result] = value
                heapq.heappush(agenda, (value[0], size(result), value[1], result))
    return done


def _edits(signature: str) -> list[list[tuple[str, Value]]]:
    """For each row of the signature (role initial, fault letter) its edits: (new initial, value)."""
    out = []
    for k in range(0, len(signature), 2):
        initial, fault = signature[k], signature[k + 1]
        found = [("", (COSTS["D"], "D"))]
        if fault not in "bd":
            more = TRUNCATED if fault == "t" else 0
            found += [(x, (COSTS["R"] + more, "R")) for x in NAMES]
            if initial in "sua":
                found = [e for e in found if e[0] != initial] + [(initial, (COSTS["K"] + more, "K"))]
        out.append(found)
    return out


@lru_cache(maxsize=20_000)
def block_spans(signature: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from state, to state, cost, audit) for the rows of one block."""
    edits = _edits(signature)
    n = len(edits)
    axioms = [(("span", p, p, 0), (0, "")) for p in range(4)]
    axioms += [(("edit", i, x), value) for i, row in enumerate(edits) for x, value in row]
    axioms += [(("insert", x), (COSTS["I"], "I")) for x in NAMES]
    spans_at = defaultdict(list)  # row -> (from, to) of the spans that are final

    def deduce(item, done):
        if item[0] == "span":
            _, p, r, i = item
            spans_at[i].append((p, r))
            own = done[item]
            if i < n:
                for x in ("", *MOVES[r]):
                    if (other := done.get(("edit", i, x))) is not None:
                        yield ("span", p, MOVES[r][x] if x else r, i + 1), own, other
            for x in MOVES[r]:
                if x in NAMES and (other := done.get(("insert", x))) is not None:
                    yield ("span", p, MOVES[r][x], i), own, other
        elif item[0] == "edit":
            _, i, x = item
            for p, r in spans_at[i]:
                if not x or x in MOVES[r]:
                    yield ("span", p, MOVES[r][x] if x else r, i + 1), done[("span", p, r, i)], done[item]
        else:
            x = item[1]
            for i, found in spans_at.items():
                for p, r in found:
                    if x in MOVES[r]:
                        yield ("span", p, MOVES[r][x], i), done[("span", p, r, i)], done[item]

    # neither the start nor "after s" can be reached from a later state, nor the start from "after s"
    has_system = any(x == "s" for row in edits for x, _ in row)
    reach = {0: {0, 2, 3} | ({1} if has_system else set()), 1: {1, 2, 3}, 2: {2, 3}, 3: {2, 3}}
    wanted = {("span", p, q, n) for p, to in reach.items() for q in to}
    rows = {"span": lambda item: item[3], "edit": lambda item: 1, "insert": lambda item: 0}
    done = lightest(axioms, deduce, lambda item: rows[item[0]](item), wanted)
    return tuple((item[1], item[2], *value) for item, value in done.items() if item[0] == "span" and item[3] == n)


def joined_spans(parts: list[Iterable[tuple[int, int, int, str]]]) -> list[tuple[int, int, int, str]]:
    """The spans over neighbouring blocks, in order, from the spans of each."""
    n = len(parts)
    axioms = [(("span", p, q, k, k + 1), (cost, audit)) for k, spans in enumerate(parts) for p, q, cost, audit in spans]
    heads, tails = defaultdict(list), defaultdict(list)  # spans of the first k blocks; spans of block k

    def deduce(item, done):
        _, p, q, i, j = item
        if i == 0:
            heads[j, q].append(item)
            for other in tails[j, q]:
                yield ("span", p, other[2], 0, j + 1), done[item], done[other]
        if i > 0:
            tails[i, p].append(item)
            for other in heads[i, p]:
                yield ("span", other[1], q, 0, j), done[other], done[item]

    done = lightest(axioms, deduce, lambda item: item[4] - item[3])
    return [(item[1], item[2], *value) for item, value in done.items() if item[3:] == (0, n)]


def goal(spans: Iterable[tuple[int, int, int, str]]) -> Value:
    """The least of the spans that lead from the start to an end."""
    return min((cost, audit) for p, q, cost, audit in spans if p == 0 and q in ENDS)


SPANS = "array<struct<p:int,q:int,cost:long,audit:string>>"


def _structs(spans) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for p, q, cost, audit in spans]


def _derived(signature: Column) -> Column:
    @F.pandas_udf(SPANS)
    def derived(column: pd.Series) -> pd.Series:
        return pd.Series([_structs(block_spans(s)) for s in column], dtype=object)

    return derived(signature)


def _joined(parts: Column) -> Column:
    @F.pandas_udf(SPANS)
    def joined(column: pd.Series) -> pd.Series:
        groups = ([[(s["p"], s["q"], s["cost"], s["audit"]) for s in part["spans"]] for part in group] for group in column)
        return pd.Series([_structs(joined_spans(g)) for g in groups], dtype=object)

    return joined(parts)


def _goal(spans: Column) -> Column:
    @F.pandas_udf("cost long, audit string")
    def goals(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([goal((s["p"], s["q"], s["cost"], s["audit"]) for s in each) for each in column], columns=["cost", "audit"])

    return goals(spans)


def _named(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest) with the defined values for nulls; the digest orders rows of one turn."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), body.alias("text"), F.md5(body).alias("digest"))


ORDER = ("turn", "role", "digest")
WHITE = "\t\n\x0b\x0c\r "


def _small_rows(rows: DataFrame) -> DataFrame:
    """The rows without texts, in order: ``mid`` grows from row to row of a conversation, and is
    written, so that it stays the same wherever it is read."""
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = F.when(last == "", F.lit("b")).when(last.isin(".", "!", "?"), F.lit("k")).otherwise(F.lit("t"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("-"))
    small = rows.select("conv", "turn", "role", "digest", initial.alias("initial"), fault.alias("fault"))
    ordered = small.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return materialize(ordered.withColumn("mid", F.monotonically_increasing_id()), "conversation-rows")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit): one row for each conversation of ``df``."""
    small = _small_rows(_named(df, conv, turn, role, text))
    # the first of equal messages: found by an aggregate and joined by row, so no message is a hot key
    firsts = small.filter("fault <> 'b'").groupBy("conv", "role", "digest").agg(F.min("mid").alias("mid")).select("mid", F.lit(True).alias("is_first"))
    seen = small.select("conv", "mid", "initial", "fault").join(firsts, "mid", "left")
    seen = seen.withColumn("fault", F.when((F.col("fault") != "b") & F.col("is_first").isNull(), F.lit("d")).otherwise(F.col("fault")))
    in_order = F.sort_array(F.collect_list(F.struct("mid", F.concat("initial", "fault").alias("s"))))
    blocks = (seen.groupBy("conv", F.shiftright("mid", BLOCK.bit_length() - 1).alias("block"))
              .agg(F.array_join(F.transform(in_order, lambda x: x["s"]), "").alias("signature")))
    blocks = materialize(blocks.withColumn("no", F.row_number().over(Window.partitionBy("conv").orderBy("block")) - 1),
                         "conversation-blocks")
    return _facts(small, blocks).join(_audits(blocks), F.col("conv").eqNullSafe(F.col("conv_"))).drop("conv_")


def _facts(small: DataFrame, blocks: DataFrame) -> DataFrame:
    """Counts for each conversation; neighbours across a block's border meet through the blocks' first and last roles."""
    faults = F.regexp_replace("signature", "(.)(.)", "$2")
    roles = F.regexp_replace("signature", "(.)(.)", "$1")
    known = blocks.select("conv", "no", faults.alias("faults"), roles.alias("roles"))
    before = F.lag(F.right("roles", F.lit(1))).over(Window.partitionBy("conv").orderBy("no"))
    known = known.withColumn("roles", F.concat(F.coalesce(before, F.lit("")), "roles"))
    pairs = F.greatest(F.length("roles") - 1, F.lit(0))
    legal = F.regexp_count("roles", F.lit("(?=su|ua|au)"))
    by = known.groupBy("conv").agg(*[F.sum(F.length("faults") - F.length(F.replace("faults", F.lit(c)))).cast("long").alias(n)
                                     for c, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
                                   F.sum(pairs - legal).cast("long").alias("illegal"))
    turns = small.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    by = by.withColumnRenamed("conv", "by_conv")
    return turns.join(by, F.col("conv").eqNullSafe(F.col("by_conv"))).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal")


def _audits(blocks: DataFrame) -> DataFrame:
    """(conv_, cost, audit) from the blocks' spans, joined in rounds; a round divides the longest conversation by ``FAN``."""
    last = blocks.agg(F.max("no")).first()[0] or 0
    spans = blocks.select("conv", "no", _derived(F.col("signature")).alias("spans"))
    while last > 0:
        spans = materialize(spans, "conversation-spans")
        group = F.sort_array(F.collect_list(F.struct("no", "spans"))).alias("parts")
        grouped = spans.groupBy("conv", F.floor(F.col("no") / FAN).cast("int").alias("no")).agg(group)
        lone = grouped.filter(F.size("parts") == 1).select("conv", "no", F.col("parts")[0]["spans"].alias("spans"))
        spans = lone.union(grouped.filter(F.size("parts") > 1).select("conv", "no", _joined(F.col("parts")).alias("spans")))
        last //= FAN
    return spans.select(F.col("conv").alias("conv_"), _goal(F.col("spans")).alias("g")).select("conv_", "g.*")


def _messages(audit: str) -> Iterator[tuple[str, str]]:
    """(edit, role initial or "" for the row's own) of an audit. The form has one reading: an s can
    only be a kept first row, which is known from the number of messages, then u and a take turns."""
    n = sum(1 for e in audit if e != "D")
    place = -(n % 2)  # an odd number of messages begins with s
    for edit in audit:
        if edit == "D":
            yield edit, ""
            continue
        yield edit, "" if edit == "K" else "ua"[place % 2]
        place += 1


def _sorted_with_audits(df: DataFrame, report: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows of each conversation behind its audit, in the order of the audit's letters."""
    rows = _named(df, conv, turn, role, text).select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    audits = report.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                           F.lit("").alias("digest"), F.col("audit").alias("text"))
    return (audits.union(rows).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
            .select("conv", "kind", "role", "text"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("begin", conv), ("message", edit, role, text) and ("end",) events of sorted rows."""
    edits = None

    def rest(edits):
        for edit, initial in edits:  # behind the last row there are insertions only
            yield "message", edit, NAMES[initial], ""

    for batch in batches:
        kinds, roles, texts = (batch.column(k).to_pylist() for k in (1, 2, 3))
        for k, kind in enumerate(kinds):
            if kind == 0:
                if edits is not None:
                    yield from rest(edits)
                    yield ("end",)
                edits = _messages(texts[k])
                yield "begin", batch.column(0).slice(k, 1)
                continue
            for edit, initial in edits:
                if edit == "I":
                    yield "message", edit, NAMES[initial], ""
                    continue
                if edit != "D":
                    yield "message", edit, NAMES.get(initial, roles[k]), texts[k]
                break
    if edits is not None:
        yield from rest(edits)
        yield ("end",)


def repaired(df: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv, place, edit, role, text): the messages of the repaired conversations, numbered from 0."""
    rows = _sorted_with_audits(df, report, conv, turn, role, text)
    kind = rows.schema["conv"].dataType.simpleString()

    def messages(batches):
        out, own, place, size = [], None, 0, 0

        def batch():
            convs = pa.concat_arrays([_plain(o[0]) for o in out])
            columns = list(zip(*[o[1:] for o in out]))
            return pa.RecordBatch.from_arrays(
                [convs, pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]],
                names=["conv", "place", "edit", "role", "text"])

        for event in _walk(batches):
            if event[0] == "begin":
                own, place = event[1], 0
            elif event[0] == "message":
                out.append((own, place, *event[1:]))
                place, size = place + 1, size + len(event[3])
                if len(out) >= 10_000 or size > 1 << 20:
                    yield batch()
                    out, size = [], 0
        if out:
            yield batch()

    return rows.mapInArrow(messages, f"conv {kind}, place long, edit string, role string, text string")


def _plain(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def digests(df: DataFrame, report: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, repaired_sha256) over the repaired messages ``role:text``, joined by newlines."""
    rows = _sorted_with_audits(df, report, conv, turn, role, text)
    kind = rows.schema["conv"].dataType.simpleString()

    def hashed(batches):
        convs, shas, state, first = [], [], None, True

        def batch():
            return pa.RecordBatch.from_arrays([pa.concat_arrays([_plain(c) for c in convs]), pa.array(shas, pa.string())],
                                              names=["conv", "repaired_sha256"])

        for event in _walk(batches):
            if event[0] == "begin":
                convs.append(event[1])
                state, first = hashlib.sha256(), True
            elif event[0] == "message":
                state.update(("" if first else "\n").encode() + f"{event[2]}:".encode("utf-8", "surrogatepass")
                             + event[3].encode("utf-8", "surrogatepass"))
                first = False
            else:
                shas.append(state.hexdigest())
                if len(shas) >= 10_000:
                    yield batch()
                    convs, shas = [], []
        if shas:
            yield batch()

    return rows.mapInArrow(hashed, f"conv {kind}, repaired_sha256 string")


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The stand-in input of the query: rows damaged by crc32 of ``conv:turn`` modulo 20 (0 drops a
    row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats the row, 4 makes its role user)."""
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(words(conv), F.lit(":"), words(turn))) % 20
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), words(role).alias("role"), words(text).alias("text"), fault.alias("fault"))
    rows = rows.filter("fault <> 0")
    new_text = (F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
                .otherwise(F.col("text")))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       new_text.alias("text"), copies.alias("copy")).drop("copy")
