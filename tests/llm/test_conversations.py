"""Structure repair and the prefix trie against brute force, on conversations
with nulls, ties, repeats, absent turns and long runs."""

import hashlib
import random
import zlib

import pytest

from lakeshelf.llm import prefix_trie, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, cost long, seen string"  # the last two clash with computed names
USER, ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}


def cheapest(rows):
    """(cost, audit, lines) by a table of whole strings."""
    best = {0: (0, "", ())}

    def inserted(table):
        for _ in range(3):
            for s, (c, a, r) in list(table.items()):
                for moves, role in ((USER, "user"), (ASSISTANT, "assistant")):
                    if s in moves:
                        new = (c + 3, a + "I", r + (f"{role}:",))
                        table[moves[s]] = min(table.get(moves[s], new), new)
        return table

    best = inserted(best)
    for role, text, forced, cut in rows:
        new = {}

        def offer(s, *x):
            new[s] = min(new.get(s, x), x)

        for s, (c, a, r) in best.items():
            offer(s, c + 4, a + "D", r)
            if forced:
                continue
            if role[:1] == "s" and s == 0:
                offer(1, c + 3 * cut, a + "K", r + (f"{role}:{text}",))
            for moves, name in ((USER, "user"), (ASSISTANT, "assistant")):
                if s in moves:
                    if role[:1] == name[0]:
                        offer(moves[s], c + 3 * cut, a + "K", r + (f"{role}:{text}",))
                    offer(moves[s], c + 3 + 3 * cut, a + "R", r + (f"{name}:{text}",))
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def brute_repair(rows):
    """Of (conv_id, turn, role, text) rows after damage."""
    out = {}
    for conv_id in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ", t) for c, t, r, x in rows if c == conv_id))
        seen, faults, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text, _ in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            faults.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [r[2][:1] for r in mine]
        turns = [r[4] for r in mine if r[4] is not None]
        cost, audit, lines = cheapest(faults)
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, conversations=40, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why?", "a b c", "Ünï!", None, "line\nline.", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "sage"]
    weights = [8, 8, 3, 1, 1, 1, 1]
    rows = []
    for c in [None, *range(conversations)]:
        for t in range(rng.randrange(longest + 1)):
            rows.append((c, rng.choice([t, t, t, None, t // 2, t + 3]), rng.choices(roles, weights)[0], rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    rows += rng_repeat(rows)
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(df).collect()}
    assert got == brute_repair(rows)
    kept = {}
    for r in turn_repair.repaired(df).orderBy("conv_id", "place").collect():
        kept.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, stats in got.items():
        assert hashlib.sha256("\n".join(kept.get(c, [])).encode()).hexdigest() == stats[-1]


def rng_repeat(rows):
    return [r for i, r in enumerate(rows) if i % 5 == 0]


def test_damage_and_absent_turns(spark):
    rows = [(c, t, "user", f"Text {c} {t}. Go!") for c in range(30) for t in range(3)]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    expected, after = {}, []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{c}:{t}".encode()) % 20
        after += [] if k == 0 else [(c, t, "user" if k == 4 else role, "" if k == 1 else text.translate({46: None, 33: None}) if k == 2 else text)] * (2 if k == 3 else 1)
    expected = brute_repair(after)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(turn_repair.damage(df)).collect()}
    assert got == {c: expected.get(c, nothing) for c in range(30)}
    gone = df.withColumnRenamed("seen", "other").selectExpr("*", "false AS present").where("conv_id < 2")
    assert {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(gone).collect()} == {0: nothing, 1: nothing}
    assert turn_repair.repair(df.where("false")).count() == 0


@pytest.mark.parametrize("pattern", ["u", "ua", "uua", "aau", "suua", "uuaa"])
def test_survivors_over_long_conversations(pattern):
    """Whole comparison over long unresolved ends, bounded memory otherwise."""
    n = 3000
    rows = [(("user", "assistant", "system")["uas".index(pattern[i % len(pattern)])], f"{i}.", False, False) for i in range(n)]
    edits = []
    s = turn_repair.Survivors(edits.append)
    for role, _, forced, cut in rows:
        s.turn(role[:1].encode(), forced, cut)
    cost = s.finish()
    short = rows[:60]
    few = []
    s2 = turn_repair.Survivors(few.append)
    for role, _, forced, cut in short:
        s2.turn(role[:1].encode(), forced, cut)
    assert (s2.finish(), "".join(few)) == cheapest(short)[:2]
    assert sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in edits) == cost
    assert sum(e != "I" for e in edits) == n
    if pattern == "ua":
        assert s.most < 200


def test_survivors_against_whole_strings():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice(["user", "user", "assistant", "system", "x"]), "", rng.random() < 0.1, rng.random() < 0.2) for _ in range(rng.randrange(40))]
        edits = []
        s = turn_repair.Survivors(edits.append)
        s.check_at = 1  # hand out as soon as possible
        for role, _, forced, cut in rows:
            s.turn(role[:1].encode() if role[0] in "sua" else b"", forced, cut)
            s.check_at = 1
        assert (s.finish(), "".join(edits)) == cheapest(rows)[:2]


# ---- prefix trie ---------------------------------------------------------------

def brute_trie(paths):
    """{(conv_id, depth): rest} of {conv_id: ((role, text), ...)}."""
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = {}
    for p, ids in members.items():
        kids = [x for x in members if len(x) == len(p) + 1 and x[:len(p)] == p]
        below = [x for x in members if x[:len(p)] == p]
        leaves = sum(not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(ids) if paths[c] == p)
        out[min(ids), len(p)] = (min(members[p[:-1]]) if p else None, len(ids), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def nodes_of(df):
    rows = df.collect()
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def trie_rows(seed, n=60):
    rng = random.Random(seed)
    texts = ["a", "b", "", None, "ça va", "x" * 3000]
    starts = [[("user", rng.choice(texts)) for _ in range(rng.randrange(1, 5))] for _ in range(4)]
    rows = []
    for c in rng.sample(range(3 * n), n):
        turns = list(rng.choice(starts)) + [(rng.choice(["user", None, "assistant"]), rng.choice(texts)) for _ in range(rng.choice([0, 0, 1, 2, 12]))]
        rows += [(c, t if t else rng.choice([0, None]), r, x, 1, "s") for t, (r, x) in enumerate(turns)]
    return rows


def paths_of(rows):
    own = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((r or "", x or ""))
    return {c: tuple(p) for c, p in own.items()}


@pytest.mark.parametrize("shard_turns", [1, 25, 1 << 16])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = trie_rows(shard_turns)
    df = spark.createDataFrame(rows + [(None, 0, "user", "lost", 1, "s")], SCHEMA)
    turns = prefix_trie.turns_of(df)
    own = paths_of(rows)
    assert nodes_of(prefix_trie.trie(prefix_trie.sequences(turns), shard_turns)) == brute_trie(own)
    again = {}
    for c, p in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, own.get(c - c % 5, ())
        again[c] = base[:h] + p[h:]
    assert nodes_of(prefix_trie.trie(prefix_trie.rebuilt(turns), shard_turns)) == brute_trie(again)


def test_trie_of_equal_and_empty_conversations(spark):
    same = [(c, t, "user", "hello", 0, "") for c in range(3000) for t in range(2)]
    df = spark.createDataFrame(same, SCHEMA)
    got = nodes_of(prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns_of(df))))
    ids = hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    assert got == {(0, 0): (None, 3000, 1, 1, 2 * 2999 * 5, none), (0, 1): (0, 3000, 1, 1, 2 * 2999 * 5, none), (0, 2): (0, 3000, 0, 1, 2999 * 5, ids)}
    assert prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns_of(df.where("false")))).count() == 0


def test_double_array_steps():
    import numpy as np
    rng = random.Random(3)
    seqs = sorted({tuple(rng.choices(range(1, 9), k=rng.randrange(0, 6))) for _ in range(400)})
    trie = prefix_trie.DoubleArray([np.array(s, dtype=np.int64) for s in seqs], 8)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    node = {(): 0}
    for p in sorted(prefixes, key=len):
        if p:
            node[p] = int(trie.step(np.array([node[p[:-1]]]), np.array([p[-1]]))[0])
    assert len(set(node.values())) == len(prefixes) == sum(map(len, trie.levels)) and -1 not in node.values()
    for p in prefixes:
        for c in range(1, 9):
            assert (int(trie.step(np.array([node[p]]), np.array([c]))[0]) >= 0) == (p + (c,) in prefixes)
