"""Conversation structure repair by a checkpointed DP.

The rows of a conversation, in the order of ``turn`` (nulls first; within a turn by
role, then by MD5 of the text), are edited at least cost until the initials of
their roles read ``(s?(ua)+)?``.  Per row: Keep (0), Rerole to user or assistant (1),
Delete (2, required for blank and duplicate rows); an empty user or assistant row
can be Inserted anywhere (5); a truncated row that is not deleted costs 5 more.  Of the
cheapest edit sequences the one whose initials (``D I K R``) are ASCII-least is taken.

The pattern has four states, so the DP keeps a vector of four costs.  Backward
vectors are stored at every square root of a segment's rows only, and a block
between two checkpoints is computed again when the forward walk enters it.

At scale: rows are range-partitioned and sorted, so a conversation lies in
neighbouring rows, and each Arrow batch is cut into segments of one conversation.
Only segments at the edge of a batch can belong to a longer conversation.  These
report a four-by-four cost matrix each; a stream over a conversation's matrices
(one row per segment, never held together) gives each segment the costs behind it,
every segment walks from each of the four states, and a second stream picks the
walk that connects.  So a conversation with a third of all rows is repaired by many
tasks.  Rows for which a text was seen in an earlier segment come from one grouping by
conversation and checksum, with one row per segment.

Only the digest of a whole conversation is sequential by nature: SHA-256 of its
repaired rows runs over its segments in one task, as a stream.

Defined cases: null role or text counts as one space (so such a text is blank and
such a role is never kept); a null ``conv_id`` is a conversation of its own; null turns
come first and do not count for gaps; rows equal in all columns are repeated rows,
the later ones duplicates; a conversation without rows has no edits; a very long text is
one row of a segment; a batch of long texts is held by one task; an empty table gives an
empty result.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import same_key, ship, store, table

BLANK = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
INF = 1 << 50
#: States: 0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant.
TURN = (2, 2, 3, 2)  # an inserted or rerolled row takes the role that comes next
KEPT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
NONE = (-1, -1, -1, -1)
ROLE = {2: "user", 3: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)


def with_inserts(v: list[int]) -> tuple[int, ...]:
    """Costs when rows may be inserted first; a third insert brings nothing."""
    return tuple(min(v[q], INSERT + v[TURN[q]], 2 * INSERT + v[TURN[TURN[q]]]) for q in range(4))


def back(code: tuple, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state before a row, given those after it.  ``code`` is
    ``(states after keeping the row, must be deleted, extra cost if not)``."""
    kept, gone, extra = code
    out = []
    for q in range(4):
        c = DELETE + v[q]
        if not gone:
            c = min(c, REROLE + extra + v[TURN[q]])
            if kept[q] >= 0:
                c = min(c, KEEP + extra + v[kept[q]])
        out.append(c)
    return with_inserts(out)


def checkpoints(codes: list[tuple], end: tuple[int, ...]) -> tuple[int, dict]:
    """``(block length, {row: costs before it})`` at every block's start."""
    step = max(1, math.isqrt(len(codes)))
    marks, v = {len(codes): end}, end
    for i in range(len(codes) - 1, -1, -1):
        v = back(codes[i], v)
        if i % step == 0:
            marks[i] = v
    return step, marks


def walk(codes: list[tuple], step: int, marks: dict, q: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits from state ``q``, and the state they end in."""
    out, n = [], len(codes)
    for begin in range(0, n, step):
        stop = min(n, begin + step)
        vs = [marks[stop]]
        for i in range(stop - 1, begin - 1, -1):
            vs.append(back(codes[i], vs[-1]))
        vs.reverse()
        for i in range(begin, stop):
            kept, gone, extra = codes[i]
            here, after = vs[i - begin], vs[i - begin + 1]
            while True:
                if DELETE + after[q] == here[q]:
                    out.append("D")
                    break
                if INSERT + here[TURN[q]] == here[q]:
                    out.append("I")
                    q = TURN[q]
                    continue
                if kept[q] >= 0 and KEEP + extra + after[kept[q]] == here[q]:
                    out.append("K")
                    q = kept[q]
                else:
                    out.append("R")
                    q = TURN[q]
                break
    return "".join(out), q


def finish(q: int) -> str:
    """The inserts after the last row."""
    return "I" * (END[q] // INSERT)


def matrix(codes: list[tuple]) -> list[int]:
    """Least costs of a segment from each state to each state, row by row."""
    ends = []
    for q in range(4):
        v = tuple(0 if p == q else INF for p in range(4))
        for c in reversed(codes):
            v = back(c, v)
        ends.append(v)
    return [min(ends[p][q], INF) for q in range(4) for p in range(4)]


def apply_edits(roles: list[str], texts: list[str], audit: str, q: int) -> list[tuple[str, str]]:
    """The rows that the edits leave, from state ``q`` on."""
    out, i = [], 0
    for e in audit:
        if e == "I":
            q = TURN[q]
            out.append((ROLE[q], ""))
            continue
        if e == "K":
            q = KEPT[roles[i][:1]][q]
            out.append((roles[i], texts[i]))
        elif e == "R":
            q = TURN[q]
            out.append((ROLE[q], texts[i]))
        i += 1
    return out


def judge(roles: list[str], texts: list[str], seen: set) -> tuple[list[tuple], list[int]]:
    """Codes of the rows for the DP and how many rows are blank, duplicate and
    truncated.  ``seen`` holds checksums of earlier rows."""
    codes, faults = [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        last = text.rstrip(BLANK)[-1:]
        key = _checksum(role, text)
        if not last:
            fault = 0
        elif key in seen:
            fault = 1
        else:
            fault = 2 if last not in ".!?" else None
        seen.add(key)
        if fault is not None:
            faults[fault] += 1
        codes.append((KEPT.get(role[:1], NONE), fault in (0, 1), CUT if fault == 2 else 0))
    return codes, faults


def _checksum(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _checksum_sql(r: Column) -> Column:
    return F.md5(F.concat(F.length(r["role"]).cast("string"), F.lit(":"), r["role"], r["text"]).cast("binary"))


def illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))


def turn_span(turns: list) -> tuple:
    ts = [t for t in turns if t is not None]
    return (min(ts), max(ts), len(set(ts))) if ts else (None, None, 0)


def segments(rows: DataFrame) -> DataFrame:
    """``conv_id, seg, edge, turns, rows(role, text)``: neighbouring sorted rows
    of one conversation; ``seg`` rises along a conversation, and only segments with
    ``edge`` can have others beside them."""
    ship(rows.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    # Rows that agree in all else are spread by their place in the input.
    keyed = (rows.select("conv_id", "turn", "role", "text", F.md5("text").alias("_t"), F.monotonically_increasing_id().alias("_u")))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("_t"), F.asc("_u")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_pylist()
            at = [0] + [i for i in range(1, len(conv)) if conv[i] != conv[i - 1]]
            offsets = pa.array(at + [len(conv)], pa.int32())
            role_text = pa.StructArray.from_arrays([b.column(2), b.column(3)], names=["role", "text"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(range(number, number + len(at)), pa.int64()),
                 pa.array([i in (0, len(at) - 1) for i in range(len(at))]),
                 pa.ListArray.from_arrays(offsets, b.column(1)), pa.ListArray.from_arrays(offsets, role_text)],
                names=["conv_id", "seg", "edge", "turns", "rows"])
            number += len(at)

    schema = f"conv_id {kinds['conv_id']}, seg long, edge boolean, turns array<{kinds['turn']}>, rows array<struct<role:string,text:string>>"
    return store(ordered.mapInArrow(cut, schema), "conv-segments")


_COUNTS = "lo {t}, hi {t}, turns long, blank long, duplicate long, truncated long, illegal long"
_OUT = "conv_id {c}, seg long, " + _COUNTS + ", cost long, audit string, repaired array<struct<role:string,text:string>>"
_NAMES = ["conv_id", "seg", "lo", "hi", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]


def _split(rows: list[dict]) -> tuple[list[str], list[str]]:
    return [r["role"] for r in rows], [r["text"] for r in rows]


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per segment, in the order of ``seg`` within a conversation:
    ``conv_id, seg``, its smallest and largest turn and its distinct turns (``lo,
    hi, turns``; a turn that an earlier segment ends with is not counted), its rows
    by first fault (``blank, duplicate, truncated``), ``illegal`` neighbours,
    ``cost`` (of the whole conversation, in its first segment, else 0), ``audit`` and
    the ``repaired`` rows."""
    blank = F.lit(" ")
    rows = rows.select(rows[conv_col].alias("conv_id"), rows[turn_col].alias("turn"), F.coalesce(rows[role_col].cast("string"), blank).alias("role"),
                       F.coalesce(rows[text_col].cast("string"), blank).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = _OUT.format(c=kinds["conv_id"], t=kinds["turn"])
    cut = segments(rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, seg, turns, rs in _values(b):
                roles, texts = _split(rs)
                codes, faults = judge(roles, texts, set())
                step, marks = checkpoints(codes, END)
                audit, q = walk(codes, step, marks, 0)
                audit += finish(q)
                out.append((conv, seg, *turn_span(turns), *faults, illegal(roles), marks[0][0], audit,
                            [{"role": r, "text": t} for r, t in apply_edits(roles, texts, audit, 0)]))
            yield _repaired(out, b)

    inner = cut.where(~F.col("edge")).select("conv_id", "seg", "turns", "rows").mapInArrow(whole, schema)
    return inner.unionByName(_connected(cut.where("edge"), kinds, schema))


_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _values(b: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in b.columns), strict=True)


def _emit(out: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*out, strict=True) if out else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _repaired(out: list[tuple], b: pa.RecordBatch) -> pa.RecordBatch:
    n, t = pa.int64(), b.schema
    turn = t.field("lo").type if "lo" in t.names else t.field("turns").type.value_type
    return _emit(out, **dict(zip(_NAMES, [t.field("conv_id").type, n, turn, turn, *[n] * 6, pa.string(), _ROWS], strict=True)))


def _connected(edges: DataFrame, kinds: dict, schema: str) -> DataFrame:
    """As ``repair`` for conversations that may have several segments."""
    conv, turn = kinds["conv_id"], kinds["turn"]

    # Checksums of a segment that an earlier segment of the conversation holds.
    light = edges.select("conv_id", "seg", F.explode(F.array_distinct(F.transform("rows", _checksum_sql))).alias("h"))
    first = store(light.groupBy("conv_id", "h").agg(F.min("seg").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "conv-first")
    earlier = (light.join(first, same_key(light, first, ["conv_id", "h"])).where(light["seg"] > first["first"])
               .groupBy(light["seg"].alias("_seg")).agg(F.collect_list(light["h"]).alias("earlier")))
    known = edges.join(earlier, edges["seg"] == earlier["_seg"], "left").select(
        "conv_id", "seg", "turns", "rows", F.coalesce("earlier", F.array().cast("array<string>")).alias("earlier"))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for c, seg, turns, rs, earlier in _values(b):
                roles, texts = _split(rs)
                codes, faults = judge(roles, texts, set(earlier))
                out.append((c, seg, *turn_span(turns), *faults, illegal(roles), roles[0][:1], roles[-1][:1], matrix(codes)))
            t, n = b.schema.field("turns").type.value_type, pa.int64()
            yield _emit(out, conv_id=b.schema.field("conv_id").type, seg=n, lo=t, hi=t, turns=n, blank=n, duplicate=n, truncated=n, illegal=n,
                        head=pa.string(), tail=pa.string(), matrix=pa.list_(n))

    report_schema = f"conv_id {conv}, seg long, " + _COUNTS.format(t=turn) + ", head string, tail string, matrix array<long>"
    reports = store(known.mapInArrow(report, report_schema), "conv-reports")

    def costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, v = object(), END
        for b in batches:
            out = []
            for c, seg, m in _values(b):
                last = not _same(c, current)
                if last:
                    current, v = c, END
                out.append((seg, last, list(v)))
                v = tuple(min(m[4 * q + p] + v[p] for p in range(4)) for q in range(4))
            yield _emit(out, seg=pa.int64(), last=pa.bool_(), behind=pa.list_(pa.int64()))

    # `last` is the end of the conversation: rows arrive last segment first.
    behind = (reports.select("conv_id", "seg", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
              .mapInArrow(costs_behind, "seg long, last boolean, behind array<long>"))
    behind = store(behind, "conv-behind")

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for seg, rs, earlier, last, end in _values(b):
                codes, _ = judge(*_split(rs), set(earlier))
                step, marks = checkpoints(codes, tuple(end))
                found = [walk(codes, step, marks, q) for q in range(4)]
                out.append((seg, [a + (finish(q) if last else "") for a, q in found], [q for _, q in found], marks[0][0]))
            yield _emit(out, seg=pa.int64(), audits=pa.list_(pa.string()), exits=pa.list_(pa.int32()), cost=pa.int64())

    walked = store(known.join(behind, "seg").select("seg", "rows", "earlier", "last", "behind")
                   .mapInArrow(walks, "seg long, audits array<string>, exits array<int>, cost long"), "conv-walks")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, q, before, high = object(), 0, "", None
        for b in batches:
            out = []
            for c, seg, lo, hi, head, tail, exits in _values(b):
                opens = not _same(c, current)
                if opens:
                    current, q, before, high = c, 0, None, None
                out.append((seg, q, opens, int(not opens and before + head not in ("su", "ua", "au")), int(lo is not None and lo == high)))
                q, before = exits[q], tail
                high = high if hi is None else hi
            yield _emit(out, seg=pa.int64(), entry=pa.int32(), opens=pa.bool_(), more_illegal=pa.int64(), same_turn=pa.int64())

    entry = (reports.select("conv_id", "seg", "lo", "hi", "head", "tail").join(walked.select("seg", "exits"), "seg")
             .select("conv_id", "seg", "lo", "hi", "head", "tail", "exits")
             .repartition("conv_id").sortWithinPartitions("conv_id", "seg")
             .mapInArrow(entries, "seg long, entry int, opens boolean, more_illegal long, same_turn long"))
    entry = store(entry, "conv-entries")
    chosen = (reports.join(entry, "seg").join(walked, "seg")
              .select("conv_id", "seg", "lo", "hi", (F.col("turns") - F.col("same_turn")).alias("turns"), "blank", "duplicate", "truncated",
                      (F.col("illegal") + F.col("more_illegal")).alias("illegal"),
                      F.when(F.col("opens"), F.col("cost")).otherwise(F.lit(0).cast("long")).alias("cost"),
                      F.expr("audits[entry]").alias("audit"), "entry"))

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _repaired([(*r, [{"role": x, "text": t} for x, t in apply_edits(*_split(rs), r[-1], q)]) for *r, q, rs in _values(b)], b)

    texts = edges.select(F.col("seg").alias("_seg"), "rows")
    return chosen.join(texts, chosen["seg"] == texts["_seg"]).drop("_seg").mapInArrow(edited, schema)


def _same(a: object, b: object) -> bool:
    return a == b or (a is None and b is None) or (a != a and b != b)


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults by ``crc32('conv_id:turn') % 20``: 0 drops the row, 1
    empties its text, 2 removes ``. ! ?``, 3 repeats it, 4 makes it a user's.  Null
    values count as one space in the key, the role and the text."""
    one = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), one)
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    return (rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("_kind"))
            .where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))
            .drop("_copy"))


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation from ``repair``'s rows: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    body = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    rows = store(repaired.select(*[c for c in _NAMES if c != "repaired"], body.alias("body"), F.size("repaired").alias("left")), "conv-repaired")
    key = F.col("conv_id")
    counts = rows.groupBy(key).agg(
        F.coalesce(F.max("hi") - F.min("lo") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.count(F.lit(1)).alias("_n"))

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, audit, empty, kind = object(), None, [], True, None

        def out() -> pa.RecordBatch:
            return _emit([(current, "".join(audit), sha.hexdigest())], conv_id=kind, audit=pa.string(), repaired_sha256=pa.string())

        for b in batches:
            kind = b.schema.field("conv_id").type
            for c, part, body, left in _values(b):
                if not _same(c, current):
                    if sha is not None:
                        yield out()
                    current, sha, audit, empty = c, hashlib.sha256(), [], True
                audit.append(part)
                if left:
                    sha.update(body.encode() if empty else b"\n" + body.encode())
                    empty = False
        if sha is not None:
            yield out()

    many = store(counts.where("_n > 1").select("conv_id"), "conv-many")
    several = (rows.join(many, same_key(rows, many, ["conv_id"]), "left_semi").select("conv_id", "seg", "audit", "body", "left")
               .repartition("conv_id").sortWithinPartitions("conv_id", "seg").drop("seg")
               .mapInArrow(hash_all, f"conv_id {kind}, audit string, repaired_sha256 string"))
    single = rows.join(many, same_key(rows, many, ["conv_id"]), "left_anti").select("conv_id", "audit", F.sha2("body", 256).alias("repaired_sha256"))
    texts = single.unionByName(several)
    return (counts.join(texts, same_key(counts, texts, ["conv_id"]))
            .select(counts["conv_id"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule and repaired."""
    rows = table(spark, sf_dir, "conversations")
    found = digest(repair(damage(rows)))
    ids = rows.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    return ids.join(found, same_key(ids, found, ["conv_id"]), "left").select(
        ids["conv_id"], *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _oracle_sql() -> str:
    """The rules in DuckDB: per conversation a fold over its rows from the last
    to the first, which keeps per state of the pattern the cheapest (then
    ASCII-least) edits and the rows they leave."""
    def cell(c: str, a: str, t: str) -> str:
        return f"{{'c': CAST({c} AS BIGINT), 'a': {a}, 't': {t}}}"

    def before(row: str, rest: str) -> str:  # no row is empty text, it holds a colon
        return f"{row} || CASE WHEN {rest} = '' THEN '' ELSE chr(10) || {rest} END"

    def insert(base: str, to: int) -> str:
        return cell(f"{base}.c + {INSERT}", f"'I' || {base}.a", before(f"'{ROLE[to]}:'", f"{base}.t"))

    def edits(q: int) -> str:
        to, found = TURN[q], [cell(f"st.q{q}.c + {DELETE}", f"'D' || st.q{q}.a", f"st.q{q}.t")]
        extra = f"CASE WHEN r.f = 'truncated' THEN {CUT} ELSE 0 END"
        rerole = cell(f"st.q{to}.c + {REROLE} + {extra}", f"'R' || st.q{to}.a", before(f"'{ROLE[to]}:' || r.x", f"st.q{to}.t"))
        found.append(f"CASE WHEN r.f NOT IN ('blank', 'duplicate') THEN {rerole} END")
        for initial, states in KEPT.items():
            if (k := states[q]) >= 0:
                keep = cell(f"st.q{k}.c + {extra}", f"'K' || st.q{k}.a", before("r.b", f"st.q{k}.t"))
                found.append(f"CASE WHEN r.f NOT IN ('blank', 'duplicate') AND r.s = '{initial}' THEN {keep} END")
        return f"list_min([{', '.join(found)}])"

    def row(cells: str) -> str:
        return f"{{{cells}, 's': s, 'f': f, 'b': role || ':' || text, 'x': text}}"

    kind = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    none = ", ".join(f"'q{q}': CAST(NULL AS {kind})" for q in range(4))
    end = [cell("0", "''", "''"), cell("10", "'II'", "'user:' || chr(10) || 'assistant:'"), cell("5", "'I'", "'assistant:'"), cell("0", "''", "''")]
    same = "'s': r.s, 'f': r.f, 'b': r.b, 'x': r.x"
    step = f"lambda st, r: {{{', '.join(f"'q{q}': {edits(q)}" for q in range(4))}, {same}}}"
    wider = ", ".join(f"'q{q}': list_min([st.q{q}, {insert(f'st.q{TURN[q]}', TURN[q])}])" for q in range(4))
    # Up to two inserts stand before a row: two steps over the costs without them.
    twice = f"list_reduce([m, m], lambda st, r: {{{wider}, 's': st.s, 'f': st.f, 'b': st.b, 'x': st.x}}, m)"
    fold = step.replace("lambda st, r: ", "", 1)
    body = f"list_transform([{fold}], lambda m: {twice})[1]"
    start = row(", ".join(f"'q{q}': {c}" for q, c in enumerate(end))).replace("'s': s, 'f': f, 'b': role || ':' || text, 'x': text", "'s': '', 'f': '', 'b': '', 'x': ''")
    blank = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    bits = "list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte))"
    crc = f"xor(list_reduce(list_transform(string_split({key}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda crc, byte: {bits}, CAST(4294967295 AS BIGINT)), 4294967295)"
    return f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM rows WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
    FROM damaged),
judged AS (
    SELECT *, left(role, 1) AS s, rtrim(text, {blank}) AS v FROM placed),
faulty AS (
    SELECT *, CASE WHEN v = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(v, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS f,
           lag(s) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM judged),
folded AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE f = 'blank') AS blank, count(*) FILTER (WHERE f = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE f = 'truncated') AS truncated,
           count(*) FILTER (WHERE before IS NOT NULL AND before || s NOT IN ('su', 'ua', 'au')) AS illegal,
           list_reduce(list({row(none)} ORDER BY i DESC), lambda st, r: {body}, {start}).q0 AS best
    FROM faulty GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN folded ON folded.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP12_SQL = _oracle_sql()
