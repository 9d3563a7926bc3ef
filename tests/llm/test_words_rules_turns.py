"""Spelling variants, quality rules and conversation repair against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from millrace.llm import qualityrules, spelling, turns

# --- spelling variants ------------------------------------------------------------------


def _runs(text):
    run, out = "", []
    for c in (text or "") + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c
        elif run:
            out.append("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run))
            run = ""
    return out


def _apart(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def _variants(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in _runs(text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if _apart(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def _spelled(seed, size):
    rng = random.Random(seed)
    syllables = ["an", "ter", "o", "li", "né", "ST", "gra", "Öl", "e", "ing", "ion", "ß", "x"]
    stems = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(60)]
    out = []
    for _ in range(size):
        word = rng.choice(stems[: rng.randint(1, 60)])
        if rng.random() < 0.3:
            place = rng.randrange(len(word))
            word = word[:place] + rng.choice(["", "q", word[place] * 2, "é"]) + word[place + 1 :]
        out.append(word)
    return out


@pytest.mark.parametrize("frequent", [1, 8, 500])
def test_spelling_variants_equal_brute_force(spark, frequent):
    texts = [" ".join(_spelled(k, 150)) for k in range(25)]
    # chains of forms, ties, runs within other signs, a run of one letter that is deleted
    texts += ["aaaaa " * 3 + "aaaab " * 6 + "aaabb " * 12 + "aabbb " * 24 + "abbbb_48x " * 48, "aaaac-aaaac,aaaac1" * 2]
    texts += [None, "", "é", "7 8 9", "Z" * 3000 + " ", "ÀÿÀÿÀ " * 3 + "ÀÿÀÿ÷ " * 7, " ".join("abcdefghij"[:k] for k in range(1, 11))]
    rows = [*enumerate(texts), (None, texts[0]), (None, None), (3, texts[3])]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = [tuple(r) for r in spelling.variants(frame, frequent).collect()]
    assert len(got) == len(set(got)) and set(got) == _variants(rows)
    assert any(r[4] > 2 for r in got) and sum(r[1] is not None for r in got) > 10
    assert spelling.variants(frame.where("false")).count() == 0


def test_gram_bounds_hold_for_every_edit():
    rng = random.Random(4)
    for _ in range(60):
        vocabulary = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 9))) for _ in range(30)]
        seen = Counter()
        for word in vocabulary:
            text = spelling.padded(word)
            seen.update(text[p : p + q] for q in (2, 3, 4) for p in range(len(text) - q + 1))
        table = spelling.Grams(dict(seen), rng.choice([1, 2, 5, 20]))

        def read(word):
            text = spelling.padded(word)
            grams = table.of(text)
            bound = table.affected(text, grams)
            return Counter(text[a:b] for a, b in grams), bound, set(table.lists(text, grams, bound))

        for word in vocabulary[:6]:
            grams, bound, lists = read(word)
            for place, letter in product(range(len(word) + 1), "abcd"):
                for other in (word[:place] + letter + word[place:], word[:place] + letter + word[place + 1 :]):
                    if other == word:
                        continue
                    grams_o, bound_o, lists_o = read(other)
                    shared = sum((grams & grams_o).values())
                    assert shared >= max(1, sum(grams.values()) - bound, sum(grams_o.values()) - bound_o)
                    moved = {(g, p - 1) for g, p in lists_o} if len(other) > len(word) else set()
                    assert lists & (lists_o | moved), (word, other)


# --- quality rules ----------------------------------------------------------------------


def _counts(text):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]
    windows = Counter(tuple(words[p : p + 3]) for p in range(len(words) - 2))
    covered = {q for p in range(len(words) - 2) if windows[tuple(words[p : p + 3])] > 1 for q in range(p, p + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.add(line)
    n = len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, words)), symbols, dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def _good(rng, n=60):
    return "The " + " ".join(rng.choice(["of", "the", "morning", "river", "in", "walked", "slowly", "été"]) + str(rng.randrange(40)) for _ in range(n)) + "."


def _junk(rng, n=60):
    return " ".join(rng.choice(["xk%%%", "pq###", "|", "&&&"]) + str(rng.randrange(90)) + "$$$" for _ in range(n))


def test_quality_rules_count_and_reject(spark):
    rng = random.Random(11)
    rows = [(i, _good(rng)) for i in range(300)] + [(1000 + i, _junk(rng)) for i in range(100)]
    odd = ["", None, " \n ", "a b c", "one two three " * 40, "x\0y " * 60, "l1 a\nl1 a\n \n \nl1 a\n" * 9, "é" * 100_000, "w " * 50]
    odd += [_good(rng, 48), _good(rng, 49), _good(rng, 50), "a b c d a b c a b", _good(rng, 30_000)]
    rows += [(2000 + i, t) for i, t in enumerate(odd)] + [(None, _good(rng)), (5, rows[5][1])]
    frame = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, n_words int, kept boolean").repartition(3)
    held = {i for i, _ in rows[:400] if i % 4 == 3}
    labels = [(i, int(i < 1000)) for i, _ in rows[:400] if i not in held] + [(None, 1), (99_999, 0), (2001, None), (2002, 7)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = qualityrules.judge(frame, marks, 400, 200).collect()
    want = Counter((i, *_counts(t)) for i, t in rows)
    assert Counter((r["doc_id"], *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in got if r["doc_id"] in held)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    plain = qualityrules.judge(frame, marks.where("quality = 1")).collect()
    assert all(r["kept"] != r["base_failed"] and r["p_good"] is None for r in plain)
    assert qualityrules.judge(frame.where("false"), marks).count() == 0


def test_batched_scores_equal_features_one_by_one():
    rng = random.Random(5)
    weights = np.random.default_rng(1).normal(size=(2 << qualityrules.BITS) + 1)
    texts = [("".join(rng.choice("ab é\n#") for _ in range(rng.randint(0, 40)))).encode() for _ in range(300)] + [b"", b"\0 a\0b", _good(rng, 9000).encode()]
    want = [weights[b] @ s + weights[-1] for b, s in map(qualityrules.features, texts)]
    assert np.allclose(qualityrules.scores(texts, weights), want)
    assert np.allclose(qualityrules.scores(texts[:1], weights), want[:1])


def test_calibration_turns_scores_into_shares():
    rng = np.random.default_rng(3)
    score = rng.normal(size=20_000)
    good = rng.random(20_000) < 1 / (1 + np.exp(-(3 * score - 1)))
    slope, offset = qualityrules.calibrate(score, good)
    assert abs(slope - 3) < 0.2 and abs(offset + 1) < 0.1


# --- conversation repair ----------------------------------------------------------------


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def _faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def _audits(rows, faults):
    """All sensible edit lists by plain recursion: (cost, audit, roles of the output)."""
    order = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
    layer = {"": [(0, "", ())]}

    def inserted(layer):
        out = defaultdict(list)
        for before, paths in layer.items():
            for cost, audit, lines in paths:
                state = before
                for _ in range(3):
                    out[state].append((cost, audit, lines))
                    state = nexts[state]
                    cost, audit, lines = cost + 3, audit + "I", (*lines, ({"u": "user", "a": "assistant"}[state], ""))
        return out

    for (_, role, text), fault in zip(rows, faults, strict=True):
        out = defaultdict(list)
        for state, paths in inserted(layer).items():
            for cost, audit, lines in paths:
                out[state].append((cost + 4, audit + "D", lines))
                if fault in ("blank", "duplicate"):
                    continue
                extra = 3 * (fault == "truncated")
                if role[:1] in order[state]:
                    out[role[:1]].append((cost + extra, audit + "K", (*lines, (role, text))))
                state_r = nexts[state]
                name = {"u": "user", "a": "assistant"}[state_r]
                if role != name:
                    out[state_r].append((cost + 3 + extra, audit + "R", (*lines, (name, text))))
        # Whole lists of paths are kept but for those that are dearer than another by more than any rest can differ.
        least = min(c for paths in out.values() for c, _, _ in paths)
        layer = {s: [p for p in paths if p[0] <= least + 12] for s, paths in out.items()}
    ends = [p for s, paths in inserted(layer).items() if s in ("", "a") for p in paths]
    return min(ends, key=lambda p: p[:2])


def _repaired(rows):
    rows = _damage(rows)
    faults = _faults(rows)
    cost, audit, lines = _audits(rows, faults)
    turn = sorted({t for t, _, _ in rows if t is not None})
    gaps = turn[-1] - turn[0] + 1 - len(turn) if turn else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (
        gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    )


def _conversations(seed, number, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unit"]
    texts = ["Yes.", "No", "Why?", "", " \t", "Well!", "so. ", "é.", None, " "]
    rows = []
    for conv in range(number):
        start = rng.randint(-2, 3)
        for k in range(rng.randint(1, longest)):
            turn = rng.choice([start + k, start + k, start + k, None, start + 2 * k])
            text = rng.choice(texts) if rng.random() < 0.5 else f"{rng.randrange(1000)} words."
            role = ["user", "assistant"][k % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, turn, role, text))
    return rows


CONVERSATION = "conv_id long, turn long, role string, text string, said int, live string"


def test_conversation_repair_equals_brute_force(spark):
    rows = _conversations(1, 500, 5) + [(None, 0, "user", "Hi."), (None, None, None, None), (7, 1, "user", "Hi."), (7, 1, "user", "Hi.")]
    # all rows of it are dropped
    gone = next(k for k in range(1000, 9999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi.")]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    want = {(conv, *_repaired(group)) for conv, group in groups.items()}
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], CONVERSATION).repartition(3)
    got = [tuple(r) for r in turns.repair(turns.damaged(frame)).collect()]
    assert len(got) == len(want) and set(got) == want
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in want
    assert turns.repair(turns.damaged(frame.where("false"))).count() == 0


def _plain_audit(rows):
    """The same repair with whole strings in place of linked nodes."""
    best = {turns.NONE: (0, "")}

    def offer(out, state, cost, audit):
        if state not in out or (cost, audit) < out[state]:
            out[state] = (cost, audit)

    def inserted(best):
        out = dict(best)
        for _ in range(2):
            for state, (cost, audit) in list(out.items()):
                offer(out, turns.NEXT[state], cost + 3, audit + "I")
        return out

    for role, _, must_go, truncated in rows:
        out = {}
        for state, (cost, audit) in inserted(best).items():
            offer(out, state, cost + 4, audit + "D")
            if not must_go:
                kept = turns.STEP.get((state, role[:1]))
                if kept is not None:
                    offer(out, kept, cost + 3 * truncated, audit + "K")
                offer(out, turns.NEXT[state], cost + 3 + 3 * truncated, audit + "R")
        best = out
    ends = inserted(best)
    return min(ends[s] for s in (turns.NONE, turns.ASSISTANT) if s in ends)


@pytest.mark.parametrize("prime", [turns.PRIME, 7, 1])
def test_long_audits_and_hash_collisions(monkeypatch, prime):
    monkeypatch.setattr(turns, "PRIME", prime)
    rng = random.Random(prime)
    for size in [*range(1, 60), 300, 1500]:
        roles = rng.choice([["user"], ["assistant"], ["user", "assistant"], ["user", "assistant", "system", "x"]])
        rows = [(rng.choice(roles), f"{k}", rng.random() < 0.3, rng.random() < 0.3) for k in range(size)]
        audit = turns.Audit()
        for row in rows:
            audit.add(*row)
        assert audit.finish()[:2] == _plain_audit(rows)


def test_a_very_long_conversation_is_a_stream():
    audit, most = turns.Audit(), 0
    for k in range(200_000):
        audit.add("user" if k % 2 == 0 else "assistant", "text", k % 11 == 0, k % 5 == 0)
        most = max(most, len(audit.rows))
    cost, edits, _ = audit.finish()
    assert most < 200 and len(edits.replace("I", "")) == 200_000 and cost > 0
