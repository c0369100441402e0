"""Operators 11 to 13 against brute-force versions: nulls, ties, repeats, empty tables, many blocks, tight bounds."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from voltwatch.llm import conversation_repair as repair
from voltwatch.llm import lexical, minhash, substring
from voltwatch.llm import quality_rules as rules
from voltwatch.llm.common import Words, string_parts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------- 11: conversations --

MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def judged(rows):
    """Fault of each (turn, role, text), in order."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        if not last:
            out.append("blank")
        else:
            out.append("duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired) by the grammar's states: for each state the least (cost, audit) so far."""
    best = {0: (0, "", ())}
    for (_, role, text), fault in zip(rows, judged(rows), strict=True):
        for q, (c, a, o) in list(best.items()):  # one insertion before a turn; two are never cheaper
            name, q2 = NEXT[q]
            best[q2] = min(best.get(q2, (10**9, "", ())), (c + 2, a + "I", (*o, name + ":")))
        new = {}

        def take(q, way, new=new):
            new[q] = min(new.get(q, way), way)

        for q, (c, a, o) in best.items():
            take(q, (c + 3, a + "D", o))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (q, role[:1]) in MOVES:
                    take(MOVES[q, role[:1]], (c + more, a + "K", (*o, f"{role}:{text}")))
                name, q2 = NEXT[q]
                take(q2, (c + more + 2, a + "R", (*o, f"{name}:{text}")))
        best = new
    ends = {0: (0, "", ()), 1: (4, "II", ("user:", "assistant:")), 2: (2, "I", ("assistant:",)), 3: (0, "", ())}
    return min((c + ends[q][0], a + ends[q][1], o + ends[q][2]) for q, (c, a, o) in best.items())


def report(rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = judged(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, out = plain_repair(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, sha("\n".join(out)),
    )


def conversation(rnd, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "u2", ""]
    texts = ["Yes.", "no", "", " \t", "Really? \n", "well.", *(f"text {k}." for k in range(40))]
    return [(rnd.choice([None, k, k, k + 1]), rnd.choice(roles), rnd.choice(texts)) for k in range(n)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_alignment_of_a_block_joins_to_the_plain_repair():
    rnd = random.Random(3)
    for n in [0, 1, 2, 3, 5, 8, 13, 40]:
        for _ in range(60):
            rows = [(k, rnd.choice(["user", "assistant", "system", "x"]), rnd.choice(["a.", "b", "", f"{k}.", f"{k}!"])) for k in range(n)]
            pattern = ""
            for (_, role, _), fault in zip(rows, judged(rows), strict=True):
                sign = role[0] if role[0] in "sua" else "o"
                pattern += {"blank": "-", "duplicate": "="}.get(fault) or (sign.upper() if fault else sign)
            ways = repair.solve(pattern)
            got = min((c + repair._END_COST[q2], a + repair._END[q2]) for (q, q2), (c, a) in ways.items() if q == 0)
            assert got == plain_repair(rows)[:2], pattern


def test_band_leaves_cells_out_and_covers_the_incumbent():
    pattern = "ua" * 150 + "u-A" + "ua" * 150
    cost = repair.align(pattern, "a", 12)
    assert (cost < repair._NO).sum() < 0.05 * cost.size
    assert repair.solve(pattern)[0, 3] == (4, "K" * 301 + "DK" + "K" * 300)


@pytest.mark.parametrize("size", [2, 8, 2048])
def test_reports_by_block_size(spark, size):
    rnd = random.Random(size)
    talks = {k: conversation(rnd, n) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9, 12, 30, 61])}
    talks[None] = conversation(rnd, 17)
    rows = [(k, *r) for k, some in talks.items() for r in some]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r[0]: tuple(r)[1:] for r in repair.repair_report(df, size=size).collect()}
    assert got == {k: report(in_order(some)) for k, some in talks.items()}
    turns = repair.repaired(df, size=size).orderBy("conv_id", "block", "step").collect()
    for k, some in talks.items():
        mine = [r for r in turns if r.conv_id == k]
        assert "".join(r.edit for r in mine) == got[k][6]
        assert sha("\n".join(f"{r.role}:{r.text}" for r in mine if r.edit != "D")) == got[k][7]
        assert [r.fault for r in mine if r.edit != "I"] == judged(in_order(some))


def test_damage_and_every_conversation(spark):
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["Is it?", "so...", None, "é!"])) for c in [*range(40), None] for t in [None, *range(4)]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, block int, audit string")
    want = {}
    for c in [*range(40), None]:
        some = []
        for _, t, role, text in [r for r in rows if r[0] == c]:
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = (" " if role is None else role), (" " if text is None else text)
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            some += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        want[c] = report(in_order(some))
    assert {r[0]: tuple(r)[1:] for r in repair.repair_digest(df).collect()} == want
    gone = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    lost = repair.repair_digest(spark.createDataFrame([(gone, 0, "user", "a.", 1, "")], df.schema)).collect()
    assert [tuple(r) for r in lost] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert repair.repair_digest(df.limit(0)).count() == 0


# ------------------------------------------------------ 12: quality rules --


def plain_counts(text):
    words = WORD.findall(text or "")
    lines, again, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + o for k, w in enumerate(windows) if times[w] > 1 for o in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered), failed


def plain_buckets(text):
    numbers = [sum(b * pow(131, k % 64 + 1, rules.PRIME) for k, b in enumerate(w.encode())) % rules.PRIME for w in WORD.findall(text or "")]
    pairs = [(rules.FIRST * a + rules.SECOND * b) % rules.PRIME for a, b in zip(numbers, numbers[1:], strict=False)]
    return [x % rules.DIMS for x in [*numbers, *pairs]]


def rule_texts():
    rnd = random.Random(2)
    good = ["the", "of", "ñandú", "and", "house", "river,", "walks", "Blue", "stone.", "to"]
    bad = ["|", "x9#", "buy!!", "$$$", "win", "<b>"]
    prose = lambda v, n: " ".join(rnd.choice(v) + (rnd.choice("abcdefgh") if rnd.random() < 0.5 else "") for _ in range(n))
    texts = [None, "", " \n\t ", "short one", "la " * 400, "line a\n\nline a\nline a \n  \n", "w" * 300 + " " + "é" * 90, prose(good, 30000)]
    texts += [prose(good, 60 + k) for k in range(20)] + [prose(bad, 60 + k) for k in range(20)] + [prose(good, 70) + "\n" + prose(bad, 25)] * 2
    return [(None if k == 9 else k // 2 if k == 11 else k, t) for k, t in enumerate(texts)]


def test_quality_rules(spark):
    texts = rule_texts()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, weight string, kept int, n_words string"
    docs = spark.createDataFrame([(i, t, "en", None, 1, "w", 2, "n") for i, t in texts], schema)
    marks = [(k, 1) for k in range(8, 20)] + [(k, 0) for k in range(28, 40)] + [(12, 0), (None, 1), (13, 1), (7, 1)]
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks], "doc_id bigint, quality int, toxic int")
    votes = {i: [q for j, q in marks if j == i] for i, _ in marks if i is not None}
    good = {i for i, v in votes.items() if sum(v) / len(v) > 0.5}
    raw, target = Counter(), Counter()
    for i, t in texts:
        raw.update(plain_buckets(t))
        if i in good:
            target.update(plain_buckets(t))
    share = target.total() / raw.total()
    weight = {b: math.floor(1e6 * math.log((target[b] + rules.SMOOTH) / (target.total() * n / raw.total() + rules.SMOOTH))) for b, n in raw.items()}
    assert 0 < share < 1
    want = []
    for i, t in texts:
        base, grams = plain_counts(t), plain_buckets(t)
        total = sum(weight[b] for b in grams)
        want.append((i, *base, total, not base[-1] and total >= rules.FLOOR * len(grams)))
    got = [tuple(r) for r in rules.rules(docs, labels).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = rules.keep(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((i, t) for (i, t), w in zip(texts, want, strict=True) if w[-1]), key=repr)
    bad = [w for w in want if w[0] is not None and 28 <= w[0] < 48]
    assert not any(w[-1] for w in bad) and all(w[-1] for w in want if w[0] in range(12, 28))


def test_rules_without_trusted_rows_or_rows(spark):
    docs = spark.createDataFrame(rule_texts(), "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.kept != r.base_failed and r.weight == 0 for r in rules.rules(docs, none).collect())
    assert rules.rules(docs.limit(0), none).count() == 0


# ------------------------------------------------------ 13: ranked search --


def plain_search(texts, items, k=10):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in texts]
    held = [(i, c) for i, c in docs if c]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 100 - 90 + (90 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(TERM.findall((text or "").translate(LOWER))) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def search_tables(seed=4, n=700):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["Ñu", "ñu", "x_y", "a-b", "漢字", "É"]
    text = lambda n: " ".join(vocabulary[int(rnd.paretovariate(0.7)) % len(vocabulary)] for _ in range(n))
    texts = [(k, text(rnd.randrange(1, 90))) for k in range(n)]
    texts += [(n, None), (n + 1, ""), (n + 2, "--- !!"), (None, texts[3][1]), (3, texts[3][1]), (n + 3, text(30000)), (n + 4, "W1 w1 W1"), *[(n + 9 - k, texts[5][1]) for k in range(4)]]
    items = [(k, text(rnd.randrange(1, 30))) for k in range(30)] + [(30, None), (31, ""), (32, "unheard"), (5, "w1 W1 zzz"), (None, "Ñu ñu"), (33, texts[5][1])]
    return texts, items


def test_search(spark, monkeypatch):
    texts, items = search_tables()
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in texts], "doc_id bigint, text string, score int, rank string, id int").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain_search(texts, items)
    assert sorted((tuple(r) for r in lexical.search(docs, asked).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "ITEMS", 7)
    assert sorted((tuple(r) for r in lexical.search(docs, asked).collect()), key=repr) == want
    assert lexical.search(docs.limit(0), asked).count() == 0 and lexical.search(docs, asked.limit(0)).count() == 0


def test_ball_bounds_hold_and_prune():
    rnd = np.random.default_rng(1)
    width, rows = 60, []
    for k in range(640):
        some = np.unique(rnd.integers(k // 160 * 15, k // 160 * 15 + 15, 8))
        rows.append((some, rnd.integers(1, 10**10, len(some)).astype(float)))
    cut = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows])])
    every = lexical.Rows(np.arange(640), cut, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]))
    q = (rnd.random((25, width)) < 0.15).astype(float)
    tree = lexical.leaves(every, q)
    assert sorted(np.concatenate([leaf.ids for leaf, _ in tree]).tolist()) == list(range(640))
    for leaf, bound in tree:
        for at in range(len(q)):
            assert leaf.times(q[at]).max() <= bound[at]
    items = lexical.Items([" ".join(f"t{k:02d}" for k in range(15))])
    search = lexical.Search(items, 10)
    near = np.flatnonzero(every.term < 15)
    search.add(lexical.Rows(every.ids, np.searchsorted(near, cut), every.term[near], every.value[near]))
    assert 0 < search.seen < len(tree)
    whole = every.times(np.r_[np.ones(15), np.zeros(45)])
    assert search.ids[0].tolist() == np.lexsort((every.ids, -whole))[:10].tolist()


# ------------------------------------------------------- words and hashes --


def test_arranged_words_have_their_own_hashes(spark):
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    data, offsets = string_parts(pa.array([one, two, "x" * 64, "x" * 65, "x" * 128]))
    assert len(set(Words(data, offsets, 0, 5).hashes.tolist())) == 5
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id bigint, text string")
    assert all(r.kept for r in minhash.near_digest(docs).collect())
    base = " ".join(f"w{k}" for k in range(34))
    docs = spark.createDataFrame([(1, f"{base} {one}"), (2, f"{base} {two}")], "doc_id bigint, text string")
    assert [r.n_removed for r in substring.substring_digest(docs).collect()] == [0, 0]
