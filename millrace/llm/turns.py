"""Conversation structure repair by a persistent audit DP.

A conversation is read row by row in order of turn.  For each of four states (nothing yet, after a system, user or
assistant row) the cheapest edits so far are kept, ties by the ASCII-least audit string.  An audit is a chain of
linked nodes that share their prefixes: a node holds one edit, its depth, a rolling hash of the whole string and
binary-lifting ancestors.  Two audits of equal cost are compared by a longest-common-prefix search over those
ancestors; equal hashes are verified by walking back to a shared node, and a collision falls back to the plain
comparison.  Comparing prefixes decides the whole: an audit determines its path, so two audits of one state that
consumed the same rows at the same cost are never prefixes of one another.

States that cannot become cheapest any more are dropped, and as soon as the remaining audits share a prefix, it is
written to the repaired text's digest and forgotten, so a task holds the undecided rows of one conversation,
however long that is.  Rows reach it sorted; nothing is collected.  The digest is sequential by definition: rows of
one conversation pass through one task, as a stream.  Repeats are found beforehand, by (conversation, role and
text), so that no task remembers what it has seen.

Defined results: null conv_id, turn, role or text read as one space (a null conv_id is one conversation; null turns
come first); rows of one turn follow by role, then text; repeated rows are duplicates; roles other than
user, assistant and system keep their first character as initial (none: a space) and fit nowhere; a conversation
without rows after the damage has zeros, an empty audit and the digest of the empty string; an empty table gives no
rows; other columns of any name are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Costs of the edits, and what an undeleted truncated row adds.
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
SPACE = b" \t\n\v\f\r"
ENDS = b".!?"
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after system, after user, after assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEP = {
    (NONE, "s"): SYSTEM,
    (NONE, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
# The row that must come next: what an insertion or a new role makes.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
# The most that finishing from the first state can cost more than finishing from the second, by whatever rows follow.
BEHIND = {
    (ASSISTANT, NONE): COST[DELETE],
    (ASSISTANT, SYSTEM): 0,
    (ASSISTANT, USER): COST[INSERT],
    (USER, NONE): COST[INSERT] + COST[DELETE],
    (USER, SYSTEM): COST[INSERT],
    (USER, ASSISTANT): COST[INSERT],
}
BASE, PRIME = 1_000_003, (1 << 61) - 1
FLUSH = 32


class Node:
    """One edit after the edits of ``parent``: an audit string that shares its prefix."""

    __slots__ = ("edit", "depth", "hash", "up")

    def __init__(self, edit: str, parent: Node | None):
        self.edit = edit
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(edit)) % PRIME
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = up


def ancestor(node: Node, depth: int) -> Node:
    """The prefix of that length."""
    while node.depth > depth:
        steps = node.depth - depth
        node = node.up[min(len(node.up), steps.bit_length()) - 1]
    return node


def edits_from(node: Node, root: Node) -> str:
    """The edits after ``root``, one of the node's ancestors."""
    out = []
    while node is not root:
        out.append(node.edit)
        node = node.up[0]
    return "".join(reversed(out))


def same_audit(a: Node, b: Node) -> bool:
    """Whether two audits of one length are equal, to the letter: back to a node they share."""
    while a is not b:
        if a.edit != b.edit:
            return False
        if not a.up or not b.up:
            return a.depth == b.depth and not a.up and not b.up
        a, b = a.up[0], b.up[0]
    return True


def shared_node(a: Node, b: Node) -> Node:
    """The last node that both chains hold."""
    a, b = ancestor(a, b.depth), ancestor(b, a.depth)
    while a is not b:
        k = min(len(a.up), len(b.up)) - 1
        while k and a.up[k] is b.up[k]:
            k -= 1
        a, b = a.up[k], b.up[k]
    return a


def precedes(a: Node, b: Node) -> bool:
    """Whether the audit ending in ``a`` is ASCII-less than that ending in ``b``."""
    if a is b:
        return False
    left, right = ancestor(a, b.depth), ancestor(b, a.depth)
    if left.hash == right.hash and same_audit(left, right):
        return a.depth < b.depth
    # Longest common prefix: go back while the prefixes differ.
    while left.up and right.up:
        k = min(len(left.up), len(right.up)) - 1
        while k >= 0 and left.up[k].hash == right.up[k].hash:
            k -= 1
        if k < 0:
            break
        left, right = left.up[k], right.up[k]
    if left.edit != right.edit and (not left.up or same_audit(left.up[0], right.up[0])):
        return left.edit < right.edit
    # Two different prefixes had one hash: compare the letters after the shared node.
    root = shared_node(a, b)
    return edits_from(a, root) < edits_from(b, root)


class Audit:
    """The repair of one conversation, fed with its rows in order."""

    def __init__(self) -> None:
        self.root = Node("", None)
        self.best: dict[int, tuple[int, Node]] = {NONE: (0, self.root)}
        self.rows: deque[tuple[str, str]] = deque()
        self.state, self.edits, self.digest, self.lines = NONE, [], hashlib.sha256(), 0

    def _offer(self, best: dict, state: int, cost: int, parent: Node, edit: str) -> None:
        held = best.get(state)
        if held is None or cost < held[0]:
            best[state] = (cost, Node(edit, parent))
        elif cost == held[0]:
            node = Node(edit, parent)
            if precedes(node, held[1]):
                best[state] = (cost, node)

    def _insertions(self) -> None:
        """At most two rows are worth inserting in one place: user, then assistant."""
        best = self.best
        for state in (NONE, SYSTEM, ASSISTANT):
            if state in best:
                cost, node = best[state]
                self._offer(best, USER, cost + COST[INSERT], node, INSERT)
        if USER in best:
            cost, node = best[USER]
            self._offer(best, ASSISTANT, cost + COST[INSERT], node, INSERT)

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self.rows.append((role, text))
        self._insertions()
        initial, extra, after = role[:1], TRUNCATED * truncated, {}
        for state, (cost, node) in self.best.items():
            self._offer(after, state, cost + COST[DELETE], node, DELETE)
            if must_go:
                continue
            kept = STEP.get((state, initial))
            if kept is not None:
                self._offer(after, kept, cost + COST[KEEP] + extra, node, KEEP)
            self._offer(after, NEXT[state], cost + COST[REROLE] + extra, node, REROLE)
        self.best = {
            state: held
            for state, held in after.items()
            if not any(
                held[0] > other[0] + BEHIND[p, state] for p, other in after.items() if (p, state) in BEHIND
            )
        }
        if len(self.rows) >= FLUSH:
            self._settle()

    def _settle(self) -> None:
        """Write out what all remaining audits agree on; the nodes before it are let go."""
        held = iter(self.best.values())
        node = next(held)[1]
        for _, other in held:
            node = shared_node(node, other)
        if node is not self.root:
            self._write(edits_from(node, self.root))
            # The string's hash goes on from here, so lengths and hashes stay comparable.
            node.up, self.root = (), node

    def _write(self, edits: str) -> None:
        self.edits.append(edits)
        for edit in edits:
            if edit == INSERT:
                self.state = NEXT[self.state]
                self._line(ROLE[self.state], "")
                continue
            role, text = self.rows.popleft()
            if edit == KEEP:
                self.state = STEP[self.state, role[:1]]
                self._line(role, text)
            elif edit == REROLE:
                self.state = NEXT[self.state]
                self._line(ROLE[self.state], text)

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * bool(self.lines)}{role}:{text}".encode())
        self.lines += 1

    def finish(self) -> tuple[int, str, str]:
        """cost, audit and digest of the repaired rows."""
        self._insertions()
        ends = [self.best[s] for s in (NONE, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for other in ends[1:]:
            if (other[0], 0) < (cost, 0) or (other[0] == cost and precedes(other[1], node)):
                cost, node = other
        self._write(edits_from(node, self.root))
        return cost, "".join(self.edits), self.digest.hexdigest()


class Conversation:
    """Faults and repair of one conversation, fed with its rows in order of turn, role and text."""

    def __init__(self) -> None:
        self.audit = Audit()
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.before: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """``seen``: an earlier turn holds the same role and text."""
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.before and self.before[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        here = (turn, role, text)
        last = text.encode(errors="surrogatepass").rstrip(SPACE)[-1:]
        blank = not last
        duplicate = not blank and (seen or here == self.before)
        truncated = not blank and not duplicate and last not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.before = here
        self.audit.add(role, text, blank or duplicate, truncated)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.audit.finish()


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SCHEMA = f"conv_id long, {', '.join(f'{c} long' for c in NUMBERS)}, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live) after the fixed damage; a dropped row stays as one that is not live."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        (fault != 0).alias("live"),
        F.explode(F.sequence(F.lit(0), F.when(fault == 3, 1).otherwise(0))).alias("_copy"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("live"), F.col("role")).alias("role"),
        F.when(F.col("live"), F.col("text")).alias("text"),
        "live",
    )


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of ``rows`` (conv_id, turn, role, text, live)."""
    said = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("said")
    rows = rows.select("conv_id", "turn", "role", "text", "live", said)
    # Null turns come first.
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = (
        rows.where("live")
        .groupBy("conv_id", "said")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last")
        .select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said"))
    marked = rows.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", "live", F.coalesce(F.col("first") < place, F.lit(False)).alias("seen")
    )
    ordered = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, out = None, None, []
        for batch in batches:
            for conv_id, turn, role, text, live, seen in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_ is None or conv_id != current:
                    if open_ is not None:
                        out.append((current, *open_.row()))
                    current, open_ = conv_id, Conversation()
                if live:
                    open_.add(turn, role, text, seen)
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        if open_ is not None:
            out.append((current, *open_.row()))
        yield _batch(out)

    return ordered.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 9
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = ["conv_id", *NUMBERS, "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


# --- the same in SQL: whole strings in place of linked nodes ---------------------------------


def _edit(source: str, edit: str, cost: str, line: str | None) -> str:
    """SQL for a state after one more edit: cost, audit and repaired text, compared in that order."""
    text = f"{source}.t" if line is None else f"case when {source}.a similar to 'D*' then {line} else {source}.t || chr(10) || {line} end"
    return f"case when {source} is not null then {{c: {source}.c + {cost}, a: {source}.a || '{edit}', t: {text}}} end"


def _insert(source: str, role: str) -> str:
    return _edit(source, INSERT, str(COST[INSERT]), f"'{role}:'")


def _after(state: str, kept_from: dict[str, str], role: str | None) -> str:
    """SQL for the best way into a state by the row ``r``: deleted, kept, or with a new role."""
    initial = {"system": "s", "user": "u", "assistant": "a"}[state] if state != "nothing" else ""
    ways = [_edit(state, DELETE, str(COST[DELETE]), None)]
    extra = f"{TRUNCATED} * cast(truncated as int)"
    for source in kept_from.get(state, ()):
        keep = _edit(source, KEEP, extra, "role || ':' || text")
        ways.append(f"case when not must_go and left(role, 1) = '{initial}' then {keep} end")
        if role:
            renamed = _edit(source, REROLE, f"{COST[REROLE]} + {extra}", f"'{role}:' || text")
            ways.append(f"case when not must_go then {renamed} end")
    return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]


_FROM = {"system": ("nothing",), "user": ("nothing", "system", "assistant"), "assistant": ("user",)}
_KIND = "struct(c bigint, a varchar, t varchar)"
_INSERTED = f"""select * replace (least("user", {", ".join(_insert(s, "user") for s in _FROM["user"])}) as "user") from best"""
_SETTLED = f"""select * replace (least(assistant, {_insert('"user"', "assistant")}) as assistant) from ({_INSERTED})"""
OP13_SQL = f"""
with recursive crc_table as (
  select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as crcs from range(256) b(n)
), marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(
        coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: cast(ord(c) as bigint))),
      lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8))) % 20 as fault
  from conversations, crc_table
), damaged as (
  select conv_id, turn, case fault when 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from marked, range(2) copies(copy) where fault <> 0 and (copy = 0 or fault = 3)
), placed as (
  select *, row_number() over w as place,
    lag(left(role, 1)) over w || left(role, 1) not in ('su', 'ua', 'au') as illegal,
    regexp_replace(text, '[ \t\n\x0B\f\r]+$', '') as bare
  from damaged window w as (partition by conv_id order by turn nulls first, role, text)
), r as (
  select conv_id, turn, role, text, place, illegal,
    row_number() over (partition by conv_id, role, text order by place) > 1 as again, bare = '' as blank, bare <> '' and again as duplicate,
    bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') as truncated, bare = '' or again as must_go
  from placed
), best as (
  select conv_id, cast(0 as bigint) as place, cast({{c: 0, a: '', t: ''}} as {_KIND}) as nothing, cast(null as {_KIND}) as system,
    cast(null as {_KIND}) as "user", cast(null as {_KIND}) as assistant from (select distinct conv_id from conversations)
  union all
  select b.conv_id, r.place, {_after("nothing", {}, None)}, {_after("system", _FROM, None)},
    {_after("user", _FROM, "user")}, {_after("assistant", _FROM, "assistant")}
  from ({_SETTLED}) b join r on b.conv_id is not distinct from r.conv_id and r.place = b.place + 1
), ended as (
  select conv_id, least(nothing, assistant) as way
  from ({_SETTLED}) where true qualify row_number() over (partition by conv_id order by place desc) = 1
), faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank,
    count_if(duplicate) as duplicate, count_if(truncated) as truncated, count_if(illegal) as illegal from r group by conv_id
)
select e.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(way.c as bigint) as cost, way.a as audit, sha256(way.t) as repaired_sha256
from ended e left join faults f on e.conv_id is not distinct from f.conv_id
""".replace("user.", '"user".').replace("user is not", '"user" is not')
