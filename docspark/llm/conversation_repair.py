"""Conversations repaired at least cost: Re-Pair over role and fault sequences, a min-plus matrix per rule."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.llm.pair_grammar import NEVER, Transfer, chain, compress, evaluate, learn, rope_text, symbols_of
from docspark.session import materialize

#: Rows of a conversation that make one sequence of the grammar, at most.
BLOCK = 1024
#: What the repaired roles have seen so far: nothing, a system row, ... a user's, ... an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = 4
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 2, 3, 2, 1
_SOLID = "[^\\x20\\x09-\\x0D]"
_BLANKS = "' \\t\\n\\x0B\\f\\r'"
#: A row's letter tells its role's initial (s, u, a, other) and its first fault (none, truncated, blank, duplicate).
_ROLES, _FAULTS = "sua", 4
SYMBOLS = 4 * _FAULTS


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text) with faults put in by crc32 of ``conv:turn`` modulo 20; a null in the key, role or text is one blank.

    0 drops a row, 1 empties its text, 2 takes its [.!?] out, 3 repeats it, 4 makes its role user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = (F.crc32(key) % 20).cast("int")
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said)
    who = F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role).cast("string"), F.lit(" ")))
    times = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.filter(kind != 0).select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), who.alias("role"), said.alias("text"), times.alias("time"))
    return out.drop("time")


def _digest() -> Column:
    """256 bits of conversation, role and text."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))
    return F.unhex(F.sha2(F.to_json(F.struct(conv.alias("c"), F.col("role"), F.col("text"))), 256))


def _fault() -> Column:
    """1 truncated, 2 blank, else 0; whether a row was seen before is told by other rows."""
    last = F.substring(F.expr(f"trim(TRAILING {_BLANKS} FROM text)"), -1, 1)
    return F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1)


def sequences(rows: DataFrame) -> DataFrame:
    """Blocks (conv, part, block, seq, turns, low, high) of at most BLOCK rows of a conversation in order, written as a table.

    ``rows`` (conv, turn, role, text) are reduced to digests and range-partitioned by conversation, turn
    (nulls first), role and digest, so that a conversation of any size spreads over tasks and the
    position of a row in the written table is its place in the order. seq has one letter per row; turns counts the
    block's distinct turns without null, low and high are the first and last of them.
    """
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    narrow = rows.select("conv", "turn", "role", _digest().alias("digest"), kind.alias("kind"), _fault().alias("fault"))
    # rows equal in all else may fall on either side of a bound
    narrow = narrow.withColumn("spread", F.monotonically_increasing_id())
    placed = narrow.repartitionByRange(*order, "spread").sortWithinPartitions(*order)
    placed = materialize(placed.select("conv", "turn", "kind", "fault", "digest", F.monotonically_increasing_id().alias("pos")), "turns")
    # what is said twice in a conversation: the first place, combined before the shuffle
    firsts = placed.groupBy("digest").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    firsts = materialize(firsts, "said-twice")
    rows = placed.join(firsts, "digest", "left")
    fault = F.when(F.col("fault") == 2, 2).when(F.col("first") < F.col("pos"), 3).otherwise(F.col("fault"))
    letter = F.char(F.lit(97) + F.col("kind") * _FAULTS + fault)
    part, block = F.shiftright("pos", 33), F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / BLOCK)
    blocks = rows.groupBy("conv", part.alias("part"), block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", letter.alias("letter"), "turn"))).alias("x"))
    turns = F.expr("filter(array_distinct(x.turn), t -> t IS NOT NULL)")
    out = blocks.select("conv", "part", "block", F.array_join("x.letter", "").alias("seq"), F.size(turns).alias("turns"), F.array_min(turns).alias("low"), F.array_max(turns).alias("high"))
    return materialize(out, "sequences")


def letter_matrices() -> tuple[list, list]:
    """Cost and audit of every letter from state to state: inserts first, then the row's own edit; symbol 0 is no row."""
    none = [[None] * _STATES for _ in range(_STATES)]
    cost, text = [none], [none]
    after_insert = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
    for kind in range(4):
        for fault in range(_FAULTS):
            ways: dict[tuple[int, int], tuple[int, str]] = {}
            for i in range(_STATES):
                at = i
                for inserted in range(3):  # two inserts reach all that more would
                    edits = [(at, _DELETE, "D")]
                    if fault < 2:
                        extra = _TRUNCATED if fault == 1 else 0
                        edits.append((after_insert[at], _REROLE + extra, "R"))
                        if (kind == 0 and at == START) or (kind == 1 and at != USER) or (kind == 2 and at == USER):
                            edits.append((SYSTEM + kind, _KEEP + extra, "K"))
                    for j, price, sign in edits:
                        way = (inserted * _INSERT + price, "I" * inserted + sign)
                        ways[i, j] = min(ways.get((i, j), way), way)
                    at = after_insert[at]
            grid = [[ways.get((i, j), (None, None)) for j in range(_STATES)] for i in range(_STATES)]
            cost.append([[w[0] for w in row] for row in grid])
            text.append([[w[1] for w in row] for row in grid])
    return cost, text


def _product(t: Transfer, symbols: list[int]) -> tuple[list, list, list[list[list[int]]]]:
    """Cost and rank matrices of a sequence, and the state before the last symbol of each of its prefixes of two and more."""
    total = (t.cost[symbols[0]].tolist(), t.rank[symbols[0]].tolist())
    mids = []
    for s in symbols[1:]:
        c, r, m = chain(total, (t.cost[s].tolist(), t.rank[s].tolist()), _STATES)
        total = (c, r)
        mids.append(m)
    return *total, mids


def _states(mids: list[list[list[int]]], i: int, j: int) -> list[int]:
    """The states between the symbols on the best way from i to j."""
    out = [j]
    for m in reversed(mids):
        out.append(m[i][out[-1]])
    return [i, *reversed(out)]


def block_audits(blocks: DataFrame) -> DataFrame:
    """Rows (seq, costs, ranks, audits), one per distinct sequence of ``blocks``: all 16 ways through it, shared by all conversations.

    The grammar is learned from all distinct sequences; its matrices are worked out once and broadcast (of fixed size at most).
    """
    distinct = materialize(blocks.select("seq").distinct(), "distinct")
    grammar = learn(distinct, "seq", SYMBOLS + 1)
    shared = distinct.sparkSession.sparkContext.broadcast((grammar, evaluate(grammar, *letter_matrices())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, t = shared.value
        memo: dict = {}
        for batch in batches:
            x = compress(symbols_of(batch.column("seq")), grammar).tolist()
            costs, ranks, audits = [], [], []
            at = 0
            for _ in range(len(batch)):
                end = x.index(0, at)
                symbols, at = x[at:end], end + 1
                c, r, mids = _product(t, symbols)
                found = []
                for i in range(_STATES):
                    for j in range(_STATES):
                        if c[i][j] >= NEVER:
                            found.append(None)
                            continue
                        s = _states(mids, i, j)
                        found.append("".join(rope_text(t, y, s[k], s[k + 1], memo) for k, y in enumerate(symbols)))
                costs.append([v for row in c for v in row])
                ranks.append([v for row in r for v in row])
                audits.append(found)
            if len(memo) > 100_000:
                memo.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq"), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int8())), pa.array(audits, pa.list_(pa.string()))],
                ["seq", "costs", "ranks", "audits"],
            )

    return materialize(distinct.mapInArrow(run, "seq string, costs array<long>, ranks array<tinyint>, audits array<string>"), "audits")


#: Inserts that end a conversation, by the state it is in.
_CLOSE = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_ILLEGAL = {a + b for a in "suao" for b in "suao"} - {"su", "ua", "au"}


def _faults(seq: str) -> tuple[str, list[int]]:
    """The role letters of a sequence, and how many blank, duplicate, truncated and illegal places it has."""
    codes = [ord(c) - 97 for c in seq]
    roles = "".join(["suao"[c // _FAULTS] for c in codes])
    faults = [c % _FAULTS for c in codes]
    return roles, [faults.count(2), faults.count(3), faults.count(1), sum(roles[k : k + 2] in _ILLEGAL for k in range(len(roles) - 1))]


def choose_ways(blocks: DataFrame, audits: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, and ways, the state before and after each of its blocks."""
    rows = blocks.join(audits.select("seq", "costs", "ranks"), "seq")
    each = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "block", "seq", "turns", "low", "high", "costs", "ranks"))).alias("x"))
    kind = blocks.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("x").to_pylist():
                total = None
                mids, sums, roles, turns, low, high = [], [0] * 4, "", 0, None, None
                for p in parts:
                    one = tuple([p[c][i * 4 : i * 4 + 4] for i in range(_STATES)] for c in ("costs", "ranks"))
                    if total is None:
                        total = one
                    else:
                        c, r, m = chain(total, one, _STATES)
                        total = (c, r)
                        mids.append(m)
                    own, counts = _faults(p["seq"])
                    sums = [a + b for a, b in zip(sums, counts, strict=True)]
                    sums[3] += roles[-1:] + own[:1] in _ILLEGAL
                    roles = own
                    turns += p["turns"] - (high is not None and p["low"] == high)
                    low = p["low"] if low is None else low
                    high = high if p["high"] is None else p["high"]
                ends = [(total[0][START][j] + _CLOSE[j] * _INSERT, total[1][START][j], j) for j in range(_STATES)]
                cost, _, j = min(ends)
                s = _states(mids, START, j)
                ways = [{"part": p["part"], "block": p["block"], "seq": p["seq"], "way": s[k] * _STATES + s[k + 1]} for k, p in enumerate(parts)]
                out.append((0 if low is None else high - low + 1 - turns, *sums, cost, _CLOSE[j], ways))
            names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "close"]
            columns = [pa.array([o[k] for o in out], pa.int64()) for k in range(len(names))]
            way = pa.list_(pa.struct([("part", pa.int64()), ("block", pa.int64()), ("seq", pa.string()), ("way", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *columns, pa.array([o[-1] for o in out], way)], ["conv", *names, "ways"])

    schema = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, close long, ways array<struct<part:long,block:long,seq:string,way:int>>"
    return materialize(each.mapInArrow(run, schema), "ways")


def repair(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """One row per conversation of ``originals`` (a column conv): its faults, the least cost of a repair, the edits and the repaired text's digest.

    ``rows``: (conv, turn, role, text). Rows go by turn (nulls first), then role and digest of the text. A row's first fault counts: blank text,
    role and text seen earlier in the conversation, or a last character other than [.!?]. Kept roles must
    read ``(s?(ua)+)?`` by their initials. K keeps a row, R gives it the role user or assistant (2), D deletes it (3; blank and
    duplicate rows must go), I inserts a user's or assistant's row without text (2); a truncated row that stays
    costs 1. audit has the letters of the cheapest edits, the least in ASCII order among equally cheap ones.

    All roles other than s, u, a by their initial count alike. Null turns count for no gap. A conversation without rows has zeros, an
    empty audit and the empty string's digest; null is a conversation of its own. A conversation of any number of rows is spread over tasks but for its audit
    and the digest of its repaired text, which one task reads row by row.
    """
    blocks = sequences(rows)
    audits = block_audits(blocks)
    found = choose_ways(blocks, audits)
    each = found.select("conv", F.explode("ways").alias("w")).select("conv", "w.*")
    parts = each.join(audits.select("seq", "audits"), "seq").select("conv", "part", "block", F.element_at("audits", F.col("way") + 1).alias("audit"))
    whole = parts.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "block", "audit"))).alias("x")).select("conv", F.array_join("x.audit", "").alias("audit"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # null keys meet too: both sides and the conversations without rows go into one grouping
    zero = originals.select(F.col("conv"), *[F.lit(0).cast("long").alias(c) for c in [*counts, "close"]], F.lit("").alias("audit"))
    some = found.select("conv", *counts, "close", F.lit("").alias("audit"))
    named = whole.select("conv", *[F.lit(0).cast("long").alias(c) for c in [*counts, "close"]], "audit")
    summary = zero.distinct().unionByName(some).unionByName(named).groupBy("conv").agg(*[F.max(c).alias(c) for c in [*counts, "close", "audit"]])
    summary = summary.select("conv", *counts, F.concat("audit", F.expr("repeat('I', CAST(close AS INT))")).alias("audit"))
    return _repaired(rows, summary, counts)


def _repaired(rows: DataFrame, summary: DataFrame, counts: list[str]) -> DataFrame:
    """``summary`` with the digest of each repaired text: a conversation's summary comes first, its rows follow in order and are hashed one by one."""
    nothing = {"turn": "long", "role": "string", "text": "string", "digest": "binary"}
    head = summary.select("conv", F.lit(0).alias("kind"), *counts, "audit", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    body = rows.select("conv", F.lit(1).alias("kind"), *[F.lit(None).cast("long").alias(c) for c in counts], F.lit(None).cast("string").alias("audit"), "turn", "role", "text", _digest().alias("digest"))
    order = [F.col("conv").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    lines = head.unionByName(body).repartition("conv").sortWithinPartitions(*order).drop("turn", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            heads, digests = [], []
            kinds, audits, roles, texts = (batch.column(c).to_pylist() for c in ("kind", "audit", "role", "text"))
            for k, kind in enumerate(kinds):
                if kind == 0:
                    if current is not None:
                        digests.append(current.end())
                    current = _Text(audits[k])
                    heads.append(k)
                else:
                    current.row(roles[k], texts[k])
            if heads:
                summaries = batch.take(pa.array(heads)).select(["conv", *counts, "audit"])
                # the last conversation may go on in the next batch
                if len(digests) == len(heads) - 1:
                    ready, held = summaries.slice(0, len(heads) - 1), summaries.slice(len(heads) - 1)
                else:
                    ready = pa.concat_batches([waiting, summaries.slice(0, len(heads) - 1)])
                    held = summaries.slice(len(heads) - 1)
                waiting = held
                if len(ready):
                    yield pa.RecordBatch.from_arrays([*ready.columns, pa.array(digests, pa.string())], [*ready.schema.names, "repaired_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([*waiting.columns, pa.array([current.end()], pa.string())], [*waiting.schema.names, "repaired_sha256"])

    schema = f"conv {summary.schema['conv'].dataType.simpleString()}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string"
    return lines.mapInArrow(run, schema)


class _Text:
    """The repaired text of one conversation, hashed as its rows go by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.lines = audit, 0, START, hashlib.sha256(), 0

    def _line(self, line: str) -> None:
        self.hash.update((("\n" if self.lines else "") + line).encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = ASSISTANT if self.state == USER else USER
            self._line("assistant:" if self.state == ASSISTANT else "user:")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        sign = self.audit[self.at]
        self.at += 1
        if sign == "D":
            return
        if sign == "R":
            self.state = ASSISTANT if self.state == USER else USER
            role = "assistant" if self.state == ASSISTANT else "user"
        else:
            self.state = SYSTEM + _ROLES.index(role[0])
        self._line(f"{role}:{text}")

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def damaged_repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repair`` of the conversations after ``damage``: one row per original conversation, null included; other columns are not read."""
    rows = damage(conversations, conv, turn, role, text)
    return repair(rows, conversations.select(F.col(conv).alias("conv"))).withColumnRenamed("conv", conv)


def _sql_ins(x: str, line: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + 2, 'a': {x}.a || 'I', 't': {x}.t || chr(10) || '{line}:'}} END"


def _sql_edit(x: str, sign: str, cost: str, line: str, when: str = "true") -> str:
    text = f"{x}.t || chr(10) || {line}" if line else f"{x}.t"
    return f"CASE WHEN {x} IS NOT NULL AND {when} THEN {{'c': {x}.c + {cost}, 'a': {x}.a || '{sign}', 't': {text}}} END"


def _oracle() -> str:
    """The same in SQL: one step per row, with the cheapest (cost, audit, text) of each state in four columns."""
    keep, truncated = "fault <> 2 AND fault <> 3", "(fault = 1)::BIGINT"

    def rerole(x: str, role: str) -> str:
        return _sql_edit(x, "R", f"2 + {truncated}", f"'{role}:' || text", keep)

    def kept(x: str, initial: str) -> str:
        return _sql_edit(x, "K", truncated, "role || ':' || text", f"{keep} AND initial = '{initial}'")

    def delete(x: str) -> str:
        return _sql_edit(x, "D", "3", "")

    inserted = f"""SELECT d.conv, d.n, d.p0 AS i0, d.p1 AS i1, list_min([d.p2, {_sql_ins('d.p0', 'user')}, {_sql_ins('d.p1', 'user')}, {_sql_ins('d.p3', 'user')}]) AS i2,
          list_min([d.p3, {_sql_ins('d.p2', 'assistant')}, {_sql_ins(f"({_sql_ins('d.p0', 'user')})", 'assistant')}, {_sql_ins(f"({_sql_ins('d.p1', 'user')})", 'assistant')}]) AS i3,
          r.role, r.text, r.fault, r.initial
        FROM dp d JOIN numbered r ON r.conv IS NOT DISTINCT FROM d.conv AND r.n = d.n + 1"""
    return f"""WITH RECURSIVE
      crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
      hashed AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])), 4294967295) % 20 AS kind FROM conversations, crc),
      damaged AS (SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
          unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS time FROM hashed WHERE kind <> 0),
      ordered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
      numbered AS (SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2
          WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 THEN 3
          WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault,
          lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY n) || left(role, 1) AS pair FROM ordered),
      counted AS (SELECT conv, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
          count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM numbered GROUP BY conv),
      dp AS (SELECT DISTINCT conv_id AS conv, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS p0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS p1,
          NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS p2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS p3 FROM conversations
        UNION ALL
        SELECT conv, n + 1, {delete('i0')}, list_min([{delete('i1')}, {kept('i0', 's')}]),
          list_min([{delete('i2')}, {', '.join(rerole(x, 'user') for x in ('i0', 'i1', 'i3'))}, {', '.join(kept(x, 'u') for x in ('i0', 'i1', 'i3'))}]),
          list_min([{delete('i3')}, {rerole('i2', 'assistant')}, {kept('i2', 'a')}])
        FROM ({inserted})),
      ended AS (SELECT d.conv, c.*, list_min([p0, p3, {_sql_ins('p2', 'assistant')}, {_sql_ins(f"({_sql_ins('p1', 'user')})", 'assistant')}]) AS w
        FROM dp d LEFT JOIN counted c ON c.conv IS NOT DISTINCT FROM d.conv WHERE d.n = coalesce(c.rows, 0))
      SELECT conv AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, w.c::BIGINT AS cost, w.a AS audit, sha256(substr(w.t, 2)) AS repaired_sha256 FROM ended"""


ORACLE = _oracle()
