"""Conversation structure repair: the cheapest edits that make a conversation's roles read ``(s?(ua)+)?``.

1. Every row gets a symbol of its role's initial and its first fault; a conversation's symbols in order are its signature.
2. Signatures are reduced to distinct ones and sorted by their reverse. In that order equal suffixes stand together, so a task that
   walks through its range builds the suffix-shared automaton one node at a time: a node is a suffix, and
   what one signature shares with the one before is on the stack already.
3. A node is given, once for all conversations that share it and for each of four grammar states, its cost to go and
   the first edit of its best audit suffix; the rest of the suffix is the next node's. Options of equal cost
   begin with different letters, so the least letter gives the least audit, and no texts are compared.
4. Audits are joined to their conversations, whose rows then stream by in order, after the row that brings the audit.
   A task holds one row and a digest, whatever the length of a conversation.

A range of signatures begins with an empty stack: only the nodes on the path between two tasks' ranges are made twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import ship_code, stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: Grammar states: at the start, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of an initial.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What may be inserted, or a row's role be set to: the initial, and the role.
GIVEN = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
#: A row that must go; other symbols are an initial, a capital if truncated, with ``o`` for any other role.
GONE = "x"
_FAR = 1 << 60
_SPACE = r" \t\n\x0b\f\r"


class Automaton:
    """The suffix-shared automaton of signatures that come sorted by their reverse."""

    def __init__(self) -> None:
        self.nodes = [self._with_inserts([(0, ""), (_FAR, ""), (_FAR, ""), (0, "")])]
        self.path = ""
        self.made = 0

    @staticmethod
    def _with_inserts(options: list[tuple[int, str]]) -> list[tuple[int, str]]:
        """Options (cost to go, first letter) of each state, inserted rows being one more."""
        now = list(options)
        for _ in range(3):  # no best repair inserts more than two rows at one place
            for state in range(4):
                other = (now[NEXT[state][GIVEN[state]]][0] + COSTS[INSERT], INSERT)
                now[state] = min(now[state], other)
        return now

    def _node(self, symbol: str, after: list[tuple[int, str]]) -> list[tuple[int, str]]:
        self.made += 1
        more = TRUNCATED_COST if symbol.isupper() else 0
        initial = symbol.lower()
        options = []
        for state in range(4):
            choices = [(after[state][0] + COSTS[DELETE], DELETE)]
            if symbol != GONE:
                choices.append((after[NEXT[state][GIVEN[state]]][0] + COSTS[REROLE] + more, REROLE))
                if initial in NEXT[state]:
                    choices.append((after[NEXT[state][initial]][0] + COSTS[KEEP] + more, KEEP))
            options.append(min(choices))
        return self._with_inserts(options)

    def walk(self, signature: str) -> tuple[int, str]:
        """Cost and audit of a signature."""
        reverse = signature[::-1]
        shared = next((i for i, (a, b) in enumerate(zip(reverse, self.path)) if a != b), min(len(reverse), len(self.path)))
        del self.nodes[shared + 1 :]
        for symbol in reverse[shared:]:
            self.nodes.append(self._node(symbol, self.nodes[-1]))
        self.path = reverse
        state, audit = START, []
        for at in range(len(reverse), -1, -1):
            symbol = reverse[at - 1] if at else ""
            while (letter := self.nodes[at][state][1]) == INSERT:
                audit.append(letter)
                state = NEXT[state][GIVEN[state]]
            audit.append(letter)
            if letter == KEEP:
                state = NEXT[state][symbol.lower()]
            elif letter == REROLE:
                state = NEXT[state][GIVEN[state]]
        return self.nodes[-1][START][0], "".join(audit)


def audits(signatures: DataFrame) -> DataFrame:
    """Rows (signature, cost, audit) of the distinct signatures in column ``signature``."""
    ship_code(signatures.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [automaton.walk(t) for t in texts]
            yield pa.RecordBatch.from_pydict({"signature": texts, "cost": [c for c, _ in found], "audit": [a for _, a in found]}, schema=_AUDIT)

    once = signatures.select("signature").distinct()
    return once.orderBy(F.reverse("signature")).mapInArrow(run, "signature string, cost long, audit string")


_AUDIT = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])


def damaged(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, copy) with every twentieth row dropped, emptied, stripped of sentence ends, repeated and set to user.

    A dropped row stays as one whose copy is null. A null role or text is a space, and so is a null in what the damage is drawn by.
    """
    shown = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(shown(conversation), F.lit(":"), shown(turn)).cast("binary")) % 20
    rows = turns.select(F.col(f"`{conversation}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), shown(role).alias("role"), shown(text).alias("text"), drawn.alias("drawn"))
    copies = F.when(F.col("drawn") == 0, F.array().cast("array<int>")).when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    new_text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"), new_text.alias("text"), F.explode_outer(copies).alias("copy"))


def with_symbols(rows: DataFrame) -> DataFrame:
    """``rows`` with their place ``at`` in their conversation (null if dropped), fault, symbol and the initial before.

    Rows stand by turn (null first); rows of one turn by role and text. One shuffle by conversation serves all windows.
    """
    stands = F.col("copy").isNotNull()
    order = [F.asc_nulls_first("turn"), "role", "text", "copy"]
    dealt = rows.withColumn("stands", stands).withColumn("initial", F.substring("role", 1, 1)).repartition("conv")
    inside = Window.partitionBy("conv", "stands").orderBy(*order)
    earlier = F.row_number().over(Window.partitionBy("conv", "stands", "role", "text").orderBy(*order)) > 1
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    fault = F.when(~stands, None).when(last == "", "blank").when(F.col("earlier"), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    placed = dealt.withColumn("earlier", earlier).withColumns({"at": F.when(stands, F.row_number().over(inside)), "before": F.lag("initial").over(inside), "fault": fault})
    return placed.select("conv", "turn", "at", "role", "text", "fault", F.when(stands, symbol).alias("symbol"), "initial", "before")


def _facts(rows: DataFrame) -> DataFrame:
    """One row per conversation, with those that lost every row: gaps, numbers of faults, illegal pairs, signature."""
    stands = F.col("at").isNotNull()
    turn = F.when(stands, F.col("turn"))
    pair = F.concat("before", "initial")
    count = lambda c: F.count_if(c).alias
    return rows.groupBy("conv").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == name)(name) for name in ("blank", "duplicate", "truncated")],
        count(stands & F.col("before").isNotNull() & ~pair.isin("su", "ua", "au"))("illegal"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(stands, F.struct("at", "symbol")))), lambda x: x["symbol"]), "").alias("signature"),
    )


def _repair(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (a row per conversation, with its audit) with repaired_sha256, the digest of the repaired rows."""
    facts = [c for c in found.columns if c != "conv"]
    heads = found.select("conv", F.lit(0).alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.struct(*facts).alias("facts"))
    stream = rows.where("at is not null").select("conv", "at", "role", "text", F.lit(None).cast(heads.schema["facts"].dataType).alias("facts")).unionByName(heads)
    schema = f"conv {found.schema['conv'].dataType.simpleString()}, facts {heads.schema['facts'].dataType.simpleString()}, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair: _Repair | None = None
        for batch in batches:
            done, conv, facts = [], batch.column("conv"), batch.column("facts")
            for i, (at, role, text) in enumerate(zip(batch.column("at").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if at == 0:
                    if repair:
                        done.append(repair.result())
                    repair = _Repair(conv[i], facts[i])
                else:
                    repair.row(role, text)
            if done:
                yield _batch(done, batch)
        if repair:
            yield _batch([repair.result()], batch)

    sorted_rows = stream.repartition("conv").sortWithinPartitions("conv", "at")
    return sorted_rows.mapInArrow(run, schema).select("conv", "facts.*", "repaired_sha256")


def _batch(done: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
    kinds = [like.schema.field("conv").type, like.schema.field("facts").type, pa.string()]
    columns = [pa.array([d[i].as_py() if i < 2 else d[i] for d in done], type=kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["conv", "facts", "repaired_sha256"])


class _Repair:
    """One conversation's repair, row by row."""

    def __init__(self, conv, facts):
        self.conv, self.facts, self.audit = conv, facts, iter(facts["audit"].as_py())
        self.state, self.digest, self.any = START, hashlib.sha256(), False

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def given(self) -> str:
        initial = GIVEN[self.state]
        self.state = NEXT[self.state][initial]
        return ROLES[initial]

    def row(self, role: str, text: str) -> None:
        while (letter := next(self.audit)) == INSERT:
            self.put(self.given(), "")
        if letter == REROLE:
            self.put(self.given(), text)
        elif letter == KEEP:
            self.state = NEXT[self.state][role[0]]
            self.put(role, text)

    def result(self) -> tuple:
        for _ in self.audit:  # only inserted rows are left
            self.put(self.given(), "")
        return self.conv, self.facts, self.digest.hexdigest()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` are (conv, turn, role, text, copy), of which those with a null copy only name their conversation. Turns are whole
    numbers. A null conversation id is one conversation. A conversation without rows is empty: no cost, an empty audit, and the digest of
    nothing. The audit, a letter a row, is the only thing that grows with a conversation.
    """
    ship_code(rows.sparkSession)
    placed = stage(with_symbols(rows), "conversation-rows")
    facts = stage(_facts(placed), "conversation-facts")
    found = stage(audits(facts), "conversation-audits")
    return _repair(placed, facts.join(found, "signature").drop("signature"))


def repair_damaged(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repair_conversations`` of ``turns`` after damage."""
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return repair_conversations(damaged(turns, conversation, turn, role, text)).select(F.col("conv").alias(conversation), *columns)


SQL = r"""
WITH RECURSIVE table_of AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
), drawn AS (
    SELECT named.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS a
    FROM named, table_of
), damaged AS (
    SELECT conv_id, turn, copy, CASE WHEN a = 4 THEN 'user' ELSE role END AS role,
        CASE a WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM drawn, range(2) x(copy) WHERE a <> 0 AND (copy = 0 OR a = 3)
), placed AS (
    SELECT *, row_number() OVER whole AS place, left(role, 1) AS i, lag(left(role, 1)) OVER whole AS before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
    FROM damaged WINDOW whole AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), faults AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
), facts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
), ways(conv_id, place, go) AS (
    SELECT conv_id, n + 1, [{'c': 0, 'a': ''}, {'c': 4, 'a': 'II'}, {'c': 2, 'a': 'I'}, {'c': 0, 'a': ''}] FROM facts
    UNION ALL
    SELECT conv_id, place, [list_min([o[1], {'c': u.c + 2, 'a': 'I' || u.a}]), list_min([o[2], {'c': u.c + 2, 'a': 'I' || u.a}]), u, list_min([o[4], {'c': o[3].c + 2, 'a': 'I' || o[3].a}])]
    FROM (SELECT *, list_min([o[3], {'c': o[4].c + 2, 'a': 'I' || o[4].a}]) AS u FROM (
        SELECT f.conv_id, f.place, list_transform([1, 2, 3, 4], lambda s: list_min(list_filter([
            {'c': go[s].c + 3, 'a': 'D' || go[s].a},
            {'c': CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 ELSE go[CASE WHEN s = 3 THEN 4 ELSE 3 END].c + 2 + CAST(fault = 'truncated' AS INT) END, 'a': 'R' || go[CASE WHEN s = 3 THEN 4 ELSE 3 END].a},
            {'c': CASE WHEN fault IN ('blank', 'duplicate') OR NOT coalesce((i = 's' AND s = 1) OR (i = 'u' AND s <> 3) OR (i = 'a' AND s = 3), false) THEN 1000000000
                ELSE go[CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + CAST(fault = 'truncated' AS INT) END, 'a': 'K' || go[CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a}
        ], lambda x: x.c < 1000000000))) AS o
        FROM ways JOIN faults f ON f.conv_id IS NOT DISTINCT FROM ways.conv_id AND f.place = ways.place - 1))
), best AS (SELECT conv_id, go[1].c AS cost, go[1].a AS audit FROM ways WHERE place = 1
), written(conv_id, pos, place, state, out) AS (
    SELECT conv_id, 0, 0, 0, CAST([] AS VARCHAR[]) FROM best
    UNION ALL
    SELECT conv_id, pos + 1, place + CAST(letter <> 'I' AS INT),
        CASE letter WHEN 'D' THEN state WHEN 'K' THEN CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE state WHEN 2 THEN 3 ELSE 2 END END,
        CASE letter WHEN 'D' THEN out WHEN 'K' THEN list_append(out, role || ':' || text)
            ELSE list_append(out, CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END
    FROM (SELECT w.*, b.audit[w.pos + 1] AS letter, f.i, f.role, f.text FROM written w JOIN best b ON b.conv_id IS NOT DISTINCT FROM w.conv_id
        LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1 WHERE w.pos < length(b.audit))
), done AS (SELECT w.conv_id, array_to_string(out, chr(10)) AS repaired FROM written w JOIN best b ON b.conv_id IS NOT DISTINCT FROM w.conv_id WHERE pos = length(audit))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""
