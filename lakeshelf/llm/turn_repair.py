"""Conversation structure repair by Viterbi with coalescing survivors.

A conversation's turns are read in order and edited at the least cost so that
the initials of its roles spell ``(s?(ua)+)?``: Keep a turn (0), Rerole it to
user or assistant (3), Delete it (4; blank and repeated turns must go), Insert
an empty user or assistant turn (3); a truncated turn that stays adds 3. Of
equally cheap edits the ASCII-least string of initials (D, I, K, R) wins.

The pattern has four states (nothing yet, after s, after u, after a), so four
survivors are enough. Their edits form a tree of backpointers in which no two
children of a node carry the same letter: two survivors are compared whole at
the letters below their lowest common ancestor. Nodes count their references;
a branch that no survivor needs is freed, and as soon as all survivors share an
ancestor the edits up to it are final, are handed out, and their turns are
forgotten. So a task holds the unresolved end of one conversation only, and
turns are streamed: a conversation of any length needs no list of its turns.

Spark brings each conversation's turns together (one shuffle by conversation),
finds repeated turns by a window within that shuffle, and sorts with spilling.

Defined cases: a null role or text is one space, a null conv_id is a
conversation of its own, a null turn comes first; turns with the same number
come in order of role, then text; extra columns are ignored; an empty table
gives no rows; conversations whose turns are all absent give zeros, no edits
and the hash of the empty text."""

from __future__ import annotations

import hashlib
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_FAR = 1 << 40
_WHITE = b" \t\n\x0b\x0c\r"
_PAIRS = (b"su", b"ua", b"au")
#: state after a user turn or an assistant turn, by state before it
_USER, _ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}


def _plan(costs: tuple, initial: bytes, forced: bool, truncated: bool):
    """(new costs, offset, direct options by state, insertions): for each
    state the cheapest (state before, letter) pairs, several if they tie, and
    the states from which an insertion reaches states 2 and 3 as cheaply (and
    whether the direct way costs the same)."""
    extra = TRUNCATED if truncated else 0
    found: dict[int, list] = {}

    def offer(state, cost, source, letter):
        have = found.get(state)
        if have is None or cost < have[0]:
            found[state] = [cost, [(source, letter)]]
        elif cost == have[0]:
            have[1].append((source, letter))

    for s, c in enumerate(costs):
        if c >= _FAR:
            continue
        offer(s, c + DELETE, s, "D")
        if forced:
            continue
        if initial == b"s" and s == 0:
            offer(1, c + KEEP + extra, s, "K")
        for letter, moves in ((b"u", _USER), (b"a", _ASSISTANT)):
            if s in moves:
                if initial == letter:
                    offer(moves[s], c + KEEP + extra, s, "K")
                offer(moves[s], c + REROLE + extra, s, "R")
    return _with_insertions(found)


def _with_insertions(found: dict[int, list]):
    new = [found[s][0] if s in found else _FAR for s in range(4)]
    insertions = []
    for state, sources in ((2, (0, 1, 3)), (3, (2,))):
        best = min(new[s] + INSERT for s in sources)
        if best <= new[state] and best < _FAR:
            insertions.append((state, [s for s in sources if new[s] + INSERT == best], best == new[state]))
            new[state] = best
    # What can follow state 0 can follow state 3 as well, but for one system
    # turn, deleted instead; what follows state 1 can follow state 3. Such a
    # survivor that is dearer than that can't win and would hold up the others.
    for state, slack in ((0, DELETE), (1, 0)):
        if new[state] > new[3] + slack:
            new[state] = _FAR
            found.pop(state, None)
    low = min(new)
    return (tuple(c - low if c < _FAR else _FAR for c in new), low,
            [(s, options) for s, (_, options) in sorted(found.items())], insertions)


_FIRST = _with_insertions({0: [0, []]})


class Survivors:
    """The survivors of one conversation: normalised costs, their ends in the
    tree, and the edits that are final."""

    def __init__(self, emit):
        self.emit = emit  # called with each final letter
        self.plans: dict[tuple, tuple] = {}
        self.reset()

    def reset(self) -> None:
        self.parent, self.letter, self.depth = [0], [""], [0]
        self.jump, self.jump_depth, self.refs = [0], [0], [1]
        self.free: list[int] = []
        self.root, self.offset, self.check_at, self.most = 0, 0, 64, 1
        self.ends: dict[int, int] = {}
        costs, low, _, insertions = _FIRST
        self.costs, self.offset = costs, low
        self._settle({0: 0}, insertions, {})

    def live(self) -> int:
        return len(self.parent) - len(self.free)

    def _node(self, parent: int, letter: str) -> int:
        j, d = self.jump[parent], self.jump_depth[parent]
        # a skip pointer as in skew-binary lists, while its target is still there
        if d >= self.depth[self.root] and self.depth[parent] - d == d - self.jump_depth[j] and self.jump_depth[j] >= self.depth[self.root]:
            j, d = self.jump[j], self.jump_depth[j]
        else:
            j, d = parent, self.depth[parent]
        self.refs[parent] += 1
        row = (parent, letter, self.depth[parent] + 1, j, d, 0)
        if self.free:
            n = self.free.pop()
            self.parent[n], self.letter[n], self.depth[n], self.jump[n], self.jump_depth[n], self.refs[n] = row
            return n
        for column, v in zip((self.parent, self.letter, self.depth, self.jump, self.jump_depth, self.refs), row):
            column.append(v)
        return len(self.parent) - 1

    def _drop(self, n: int) -> None:
        """Frees a node that nothing refers to, and what only it referred to."""
        while self.refs[n] == 0 and n != self.root:
            self.free.append(n)
            n = self.parent[n]
            self.refs[n] -= 1

    def _lift(self, n: int, depth: int) -> int:
        while self.depth[n] > depth:
            n = self.jump[n] if self.jump_depth[n] >= depth else self.parent[n]
        return n

    def less(self, p: int, x: str, q: int, y: str) -> bool:
        """Whether the edits of p, then x, come before those of q, then y."""
        level = min(self.depth[p], self.depth[q])
        if self.depth[p] > level:
            below = self._lift(p, level + 1)
            p, x = self.parent[below], self.letter[below]
        elif self.depth[q] > level:
            below = self._lift(q, level + 1)
            q, y = self.parent[below], self.letter[below]
        if p == q:
            return x < y
        base = self.depth[self.root]
        while self.parent[p] != self.parent[q]:
            if base <= self.jump_depth[p] == self.jump_depth[q] and self.jump[p] != self.jump[q]:
                p, q = self.jump[p], self.jump[q]
            else:
                p, q = self.parent[p], self.parent[q]
        return self.letter[p] < self.letter[q]

    def _settle(self, direct: dict[int, int], insertions: list, old: dict[int, int]) -> None:
        """Adds the insertions after a turn and replaces the survivors."""
        for state, sources, ties in insertions:
            best = sources[0]
            for s in sources[1:]:
                if self.less(direct[s], "I", direct[best], "I"):
                    best = s
            if ties:
                n = direct[state]
                if not self.less(direct[best], "I", self.parent[n], self.letter[n]):
                    continue
            lost = direct.get(state)
            direct[state] = self._node(direct[best], "I")
            if lost is not None:
                self._drop(lost)
        for n in direct.values():
            self.refs[n] += 1
        for n in old.values():
            self.refs[n] -= 1
            self._drop(n)
        self.ends = direct

    def turn(self, initial: bytes, forced: bool, truncated: bool) -> None:
        key = (self.costs, initial, forced, truncated)
        plan = self.plans.get(key)
        if plan is None:
            plan = self.plans[key] = _plan(*key)
        costs, low, options, insertions = plan
        direct, old = {}, self.ends
        for state, ways in options:
            source, letter = ways[0]
            for s, x in ways[1:]:
                if self.less(old[s], x, old[source], letter):
                    source, letter = s, x
            direct[state] = self._node(old[source], letter)
        self.costs = costs
        self.offset += low
        self._settle(direct, insertions, old)
        live = self.live()
        self.most = max(self.most, live)
        if live >= self.check_at:
            self._coalesce()
            self.check_at = 64 + 2 * self.live()

    def _coalesce(self) -> None:
        """Hands out the edits above the lowest common ancestor of all
        survivors and moves the root there."""
        path, n = [], min(self.ends.values(), key=self.depth.__getitem__)
        while n != self.root:
            path.append(n)
            n = self.parent[n]
        ends = set(self.ends.values())
        while path and self.root not in ends and self.refs[self.root] - (self.root == 0 and self.depth[0] == 0) == 1:
            n = path.pop()
            self.emit(self.letter[n])
            gone, self.root = self.root, n
            self.free.append(gone)

    def finish(self) -> int:
        """Hands out the remaining edits of the best accepted survivor and
        returns the total cost."""
        a, b = self.ends.get(0), self.ends.get(3)
        end, cost = a, self.costs[0]
        if a is None or self.costs[3] < cost or (self.costs[3] == cost and self.less(b, "", a, "")):
            end, cost = b, self.costs[3]
        rest = []
        while end != self.root:
            rest.append(self.letter[end])
            end = self.parent[end]
        for x in reversed(rest):
            self.emit(x)
        return cost + self.offset


class _Conversation:
    """Turns of one conversation in, edits and statistics out."""

    def __init__(self, sink):
        self.sink = sink  # called with (edit, role, text) of each turn that stays
        self.survivors = Survivors(self._apply)
        self.start(None)

    def start(self, conv_id) -> None:
        self.conv_id = conv_id
        self.pending: deque = deque()
        self.audit: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last_turn = None
        self.distinct, self.before, self.state = 0, None, 0
        self.survivors.reset()

    def add(self, turn, role: bytes, text: bytes, seen: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.last_turn
            self.high = self.last_turn = turn
        body = text.rstrip(_WHITE)
        blank, truncated = not body, False
        if blank:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif body[-1] not in b".!?":
            truncated = True
            self.truncated += 1
        initial = role.decode("utf-8", "replace")[:1].encode()
        if self.before is not None and self.before + initial not in _PAIRS:
            self.illegal += 1
        self.before = initial
        self.pending.append((role, text))
        self.survivors.turn(initial if initial in (b"s", b"u", b"a") else b"", blank or seen, truncated)

    def _apply(self, edit: str) -> None:
        self.audit.append(edit)
        role, text = self.pending.popleft() if edit != "I" else (None, b"")
        if edit == "D":
            return
        if edit == "K" and role[:1] == b"s":
            self.state = 1
        else:
            self.state = 3 if self.state == 2 else 2
            if edit != "K":
                role = b"assistant" if self.state == 3 else b"user"
        self.sink(edit, role, text)

    def finish(self) -> dict:
        cost = self.survivors.finish()
        return {"conv_id": self.conv_id, "gaps": 0 if self.low is None else self.high - self.low + 1 - self.distinct,
                "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": cost, "audit": "".join(self.audit)}


def damage(conversations: DataFrame) -> DataFrame:
    """The test damage of the contract, by crc32(``conv_id:turn``) mod 20: 0
    drops the turn (kept as a row with ``present`` false, so that its
    conversation is known), 1 empties its text, 2 removes its ``.!?``, 3
    repeats it, 4 sets its role to user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(name.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), k.alias("k"))
    text = F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("k") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.col("k") != 0))).alias("present"))


def _in_order(turns: DataFrame) -> DataFrame:
    """Turns of each conversation together and in order, with ``seen``: an
    equal role and text came before. The window needs no shuffle of its own."""
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"))
    rows = rows.withColumn("text", F.when(F.col("present"), F.col("text")).otherwise(F.lit("")))
    same = F.substring(F.unhex(F.sha2(F.col("text"), 256)), 1, 16)
    rows = rows.withColumn("same", same).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "present", "role", "same").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("seen", F.row_number().over(earlier) > 1).drop("same")
    return rows.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "seen")


def _stream(batches, conversation: _Conversation, done):
    """Feeds sorted turns; ``done()`` at the end of each conversation; yields
    after each batch."""
    open_one = False
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("conv_id", "turn")]
        columns += [b.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text")]
        columns += [b.column(c).to_pylist() for c in ("present", "seen")]
        for conv_id, turn, role, text, present, seen in zip(*columns):
            if not open_one or conv_id != conversation.conv_id:
                if open_one:
                    done()
                conversation.start(conv_id)
                open_one = True
            if present:
                conversation.add(turn, role, text, seen)
        yield
    if open_one:
        done()
    yield


SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, text
    and, if rows are to count as absent, ``present``): faults by kind, the
    cheapest edits (``audit``), their cost, and the SHA-256 of the repaired
    ``role:text`` lines."""
    kind = turns.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {SUMMARY}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        out: list[dict] = []
        digest, first = [hashlib.sha256()], [True]

        def sink(edit, role, text):
            if not first[0]:
                digest[0].update(b"\n")
            first[0] = False
            digest[0].update(role)
            digest[0].update(b":")
            digest[0].update(text)

        conversation = _Conversation(sink)

        def done():
            out.append(conversation.finish() | {"repaired_sha256": digest[0].hexdigest()})
            digest[0], first[0] = hashlib.sha256(), True

        for _ in _stream(batches, conversation, done):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()

    return C.map_arrow(_in_order(turns), run, schema)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired turns: (conv_id, place, edit, role, text), ``place``
    counting from 0; ``edit`` is K, R or I. Conversations left without a turn
    have no row."""
    kind = turns.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, place long, edit string, role string, text string"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        out: list[dict] = []
        place = [0]

        def sink(edit, role, text):
            out.append({"conv_id": conversation.conv_id, "place": place[0], "edit": edit, "role": role.decode(), "text": text.decode()})
            place[0] += 1

        conversation = _Conversation(sink)

        def done():
            conversation.finish()
            place[0] = 0

        for _ in _stream(batches, conversation, done):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()

    return C.map_arrow(_in_order(turns), run, schema)
