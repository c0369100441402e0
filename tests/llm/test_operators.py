"""Each operator against a brute-force version on small dirty tables: nulls, empty and long texts, ties, repeats."""

import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from voltwatch.llm import bpe, decontam, edit_fingerprint, langid, minhash, pii, quality, queries, secret_scan, substring, token_counts
from voltwatch.llm.common import documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id string, copy int, part string, spans int, hot boolean, n_tokens int, id string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def make(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", None, None, 0.5, "x", 1, "p", 2, True, 3, "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "ño", "delta,", "eps", "zeta", "eta.", "theta", "Iota"]
    prose = lambda n: " ".join(rnd.choice(vocabulary) + str(rnd.randrange(30)) for _ in range(n))
    base, passage = prose(150), prose(60)
    near = base.split()
    near[70] = "changed"
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One two"), (6, base), (7, base), (8, " ".join(near)), (9, base.upper()),
        (10, prose(40) + "\n" + passage + " " + prose(30)), (11, passage + " " + prose(50)), (12, prose(20) + " " + passage),
        (13, "la " * 3000), (14, prose(20000)), (15, "a@b.co 4111 1111 1111 1111, +1 (234) 567-8901; 10.0.0.256 10.0.0.1 é@x.y"),
        (16, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" it\'s <|endoftext|> İΣΑΣ ﬁ 漢字 👍🏽'), (17, "short"), (17, "short"), (None, "no id"), (None, "no id"),
    ]
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edit_fingerprint(spark, texts):
    got = edit_fingerprint.with_next(make(spark, texts)).collect()
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, other = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        want.append((i, len(t), sha(t[: len(t) - n] + other[:n])))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=repr) == sorted(want, key=repr)
    by_id = {r.doc_id: r for r in got}
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[7].near_next == 1.0
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert by_id[14].near_edited > 0.5 > by_id[14].near_next
    assert edit_fingerprint.with_next(make(spark, texts).limit(0)).count() == 0
    one = edit_fingerprint.with_next(make(spark, [(5, "abcdef")])).collect()[0]
    assert (one.near_next, one.edited_sha256) == (1.0, sha("abcdab"))


def test_walk_equals_a_plain_walk():
    """The samples of the side-by-side walk are those of a walk one step at a time."""
    ef = edit_fingerprint
    for text in ("abc" * 40, "é漢x" * 100, "z"):
        out, i, waited = [], 0, 0
        points = [ord(c) for c in text]
        classes = ef._class(ef.np.array(points, ef.np.uint32)).tolist()
        step = 0
        while i < len(points):
            wait = int(ef._WAIT[classes[i] * ef.PERIOD + step % ef.PERIOD])
            out += [points[i]] * wait
            step += wait
            i += 1
        waited = len(out)
        f = ef.fingerprints([text])[0]
        for k, s in enumerate(ef._STEPS[: len(f)]):
            if s >= waited:
                assert f[k] == "g"
            else:
                h = int(ef.mix(ef.np.array([out[s]], ef.np.uint64) * ef.np.uint64(0x9E3779B97F4A7C15) + ef.np.uint64(k))[0]) >> 60
                assert f[k] == "0123456789abcdef"[h]


def test_edit_fingerprint_finds_edits(spark):
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefghij ") for _ in range(3000))
    other = "".join(rnd.choice("abcdefghij ") for _ in range(3000))
    edited = text[:2900] + "X" + text[2901:]
    prints = edit_fingerprint.with_fingerprints(make(spark, [(1, text), (2, edited), (3, other), (4, text), (5, None)]))
    pairs = {(r.a, r.b) for r in edit_fingerprint.near_pairs(prints, 0.8).collect()}
    assert pairs == {(1, 2), (1, 4)}


def test_edit_fingerprint_crowded_buckets_and_early_edits(spark, monkeypatch):
    """Every pair alike by brute force is found: many unlike texts of one opening among near ones, and rewritten beginnings."""
    rnd = random.Random(12)
    prose = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    opening, rows = prose(900), []
    for _ in range(20):
        own = opening + prose(1150)
        rows += [own, own[:-40] + prose(40)]
    for size in (1010, 1400, 2050):
        for _ in range(5):
            base = prose(size)
            rows += [base, prose(size // 10) + base[size // 10 :], prose(size // 5) + base[size // 5 :]]
    prints = dict(enumerate(edit_fingerprint.fingerprints(rows)))
    want = {(a, b) for a in prints for b in prints if a < b and edit_fingerprint.likeness(prints[a], prints[b]) >= 0.7}
    assert len(want) >= 30
    monkeypatch.setattr(edit_fingerprint, "CHUNK", 7)
    got = edit_fingerprint.near_pairs(edit_fingerprint.with_fingerprints(make(spark, [*enumerate(rows)])), 0.7).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)
    assert all(r.likeness == edit_fingerprint.likeness(prints[r.a], prints[r.b]) for r in got)


def test_substring(spark, texts):
    docs = [(i, WORD.findall(t or "")) for i, t in texts]
    for window in (35, 3):
        count = Counter(tuple(w[k : k + window]) for _, w in docs for k in range(len(w) - window + 1))
        want = []
        for i, w in docs:
            bad = {p for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for p in range(k, k + window)}
            want.append((i, len(w), len(bad), " ".join(x for p, x in enumerate(w) if p not in bad)))
        assert collected(substring.remove_repeats(make(spark, texts), window=window)) == sorted(want, key=repr)


def test_substring_hot_minimisers(spark, monkeypatch):
    """Documents that share a passage, with other words around it: the bucket is split, the result is the same."""
    rnd = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(40)) + " " + passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(40))) for k in range(40)]
    plain = collected(substring.remove_repeats(make(spark, rows)))
    assert all(r[2] == 60 for r in plain)
    monkeypatch.setattr(substring, "HOT", 3)
    assert collected(substring.remove_repeats(make(spark, rows))) == plain
    assert substring.remove_repeats(make(spark, rows).limit(0)).count() == 0


def test_substring_counts_windows_of_near_copies_once(spark, monkeypatch):
    """Near copies: of the windows of hot super-k-mers only those around an edit are rows, one for each distinct chunk."""
    rnd = random.Random(4)
    text = [f"p{k}" for k in range(400)]
    rows = [(k, " ".join([*text[: (at := rnd.randrange(400))], f"edit{k}", *text[at + 1 :]])) for k in range(60)]
    plain, counted, windows = collected(substring.remove_repeats(make(spark, rows))), [], substring._hot_windows

    def seen(*args):
        counted.append(windows(*args).count())
        return windows(*args)

    monkeypatch.setattr(substring, "_hot_windows", seen)
    monkeypatch.setattr(substring, "HOT", 3)
    assert collected(substring.remove_repeats(make(spark, rows))) == plain
    assert 0 < sum(counted) < 2000, counted  # every window of every hot super-k-mer: 3,157


def test_substring_of_a_row_that_stands_hundreds_of_times(spark):
    """Two long texts share a passage, so that super-k-mers are contested; one of the rows stands 400 times."""
    words = [f"w{k}" for k in range(900)]
    rows = [(1, " ".join(words[:500]))] * 400 + [(2, " ".join(words[400:900]))]
    got = Counter(collected(substring.remove_repeats(make(spark, rows))))
    (one, n), (two, m) = sorted(got.items(), key=repr)
    assert (n, one[:3], m, two[:3]) == (400, (1, 500, 500), 1, (2, 500, 100))
    assert two[3] == " ".join(words[500:900])


def test_bpe(spark, texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    docs = make(spark, texts)
    assert collected(bpe.bpe_digest(docs, path)) == sorted(want, key=repr)
    for size in (0, 7):  # any lexicon gives the same ids
        coded = bpe.encode_decode(docs, path, lexicon_size=size).select("doc_id", F.size("ids"), F.sha2(F.encode("decoded", "UTF-8"), 256))
        assert collected(coded) == sorted([(a, b, d) for a, b, _, d in want], key=repr)
    assert bpe.bpe_digest(docs.limit(0), path).count() == 0


def test_bpe_long_and_odd_words():
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    library, model = Tokenizer.from_file(path), bpe.Model(path)
    words = sorted({b"the", b"then", b"thing", b"sing", b"king"})
    encoder = bpe.Encoder(model, bpe.build_automaton(words, *model.merge(words)))
    assert encoder.automaton.find([*words, b"t", b"kings", b""]).tolist() == [0, 1, 2, 3, 4, -1, -1, -1]
    rnd = random.Random(1)
    odd = ["!" * 3000 + "ab" * 2000, "".join(rnd.choice("abcde") for _ in range(500)), "a\x1cb\x1dc\u0085d e", "they'll I'D 's", "<|endoftext|><|startoftext|>x", "É é"]
    odd += ["".join(chr(rnd.randrange(32, 0x250)) for _ in range(60)) for _ in range(200)]
    for text, ids in zip(odd, encoder.encode(odd), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_token_counts(spark, texts, tmp_path):
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = str(tmp_path / "docs.parquet")
    make(spark, texts).write.parquet(table)
    docs = spark.read.parquet(table)
    assert collected(token_counts.document_counts(docs, path, 32_000)) == sorted([(i, len(model.encode(t or ""))) for i, t in texts], key=repr)
    assert token_counts.document_counts(docs.limit(0), path, 32_000).count() == 0
    with pytest.raises(Exception, match="not free"):
        token_counts.write_tokens(docs, str(tmp_path / "bad"), path, 0x7C7F)


def test_token_counts_of_any_file(spark, tmp_path):
    import numpy as np

    files = {"a": [5, 9, 9, 1, 2, 3, 9, 4], "b": [9], "c": [1] * 10, "d": []}
    for name, tokens in files.items():
        np.array(tokens, "<u4").tofile(tmp_path / name)
    for block in (1, 2, 3, 100):
        got = {}
        for r in token_counts.token_counts(spark, str(tmp_path), 9, width=4, block=block).orderBy("path", "nth").collect():
            got.setdefault(r.path[-1], []).append((r.nth, r.n_tokens))
        assert got == {"a": [(0, 1), (1, 0), (2, 3), (3, 1)], "b": [(0, 0)], "c": [(0, 10)]}


def test_token_counts_of_a_file_beyond_2_gib(spark, tmp_path, monkeypatch):
    """A sparse file longer than Spark's rows may be, with documents over many blocks; and the way of files that only Spark opens."""
    import numpy as np

    ends = [10, 11, 300_000_000, 549_999_000]
    with open(tmp_path / "large file", "wb") as f:
        f.truncate(4 * 550_000_000 + 3)
        for k in ends:
            f.seek(4 * k)
            f.write(np.array([9], "<u4").tobytes())
    got = [r.n_tokens for r in token_counts.token_counts(spark, str(tmp_path), 9, width=4).orderBy("nth").collect()]
    assert got == [10, 0, 300_000_000 - 12, 549_999_000 - 300_000_001, 999]
    (tmp_path / "small").mkdir()
    np.array([5, 9, 9, 1, 2, 3, 9, 4], "<u2").tofile(tmp_path / "small" / "a")
    monkeypatch.setattr(token_counts, "can_open", lambda path: False)
    assert [r.n_tokens for r in token_counts.token_counts(spark, str(tmp_path / "small"), 9, block=3).orderBy("nth").collect()] == [1, 0, 3, 1]


def test_language(spark, texts):
    rows = {r.doc_id: r for r in langid.identify(documents(spark, SF)).collect()}
    docs = documents(spark, SF).collect()
    held = [d for d in docs if rows[d.doc_id].held_out]
    assert len(rows) == len(docs) and len(held) > 20
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in held) >= 0.95 * len(held)
    dirty = {r.doc_id: r for r in langid.identify(make(spark, [*texts, (30, "12 34 ..."), (31, "$$")])).collect()}
    assert [dirty[k].lang_pred for k in (1, 2, 3, 30, 31)] == ["und"] * 5 and dirty[6].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in dirty.values())
    nothing = langid.identify(make(spark, texts).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == len(texts) and {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(make(spark, texts).limit(0)).count() == 0


def test_language_rejects_what_it_never_saw(spark):
    foreign = spark.createDataFrame([(10**9 + k, "привет мир это проверка языка " * 20, None, "s", 1) for k in range(3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = documents(spark, SF)
    kept = langid.recognised(docs.union(foreign))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns and not ids & set(range(10**9, 10**9 + 3))
    assert len(ids) >= 0.99 * docs.count()


def test_samples_of_tables_a_million_times_larger(spark, monkeypatch):
    """A share below a millionth still draws rows."""
    rows = spark.range(0, 40_000_000, 1, 8).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("en").alias("lang"))
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 30)
    monkeypatch.setattr(langid, "_document_frequency", lambda rows: (langid.np.zeros(langid.DIMS, int), 40_000_000))
    model = langid.fit(rows, F.lit(True))
    assert model.langs == ["en"]
    marked = spark.range(0, 6_000_000, 1, 8).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    monkeypatch.setattr(quality, "FIT_ROWS", 5)
    assert quality.fit(rows.where("doc_id < 6000000"), marked, F.lit(True)).any()


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = {k: low if v == high else v for k, v in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


def test_minhash(spark, texts):
    rows = [r for r in texts if r[0] is not None]
    want = brute_components(dict(rows).items(), 4, 80)
    got = minhash.near_digest(make(spark, texts)).collect()
    assert len(got) == len(texts)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert minhash.near_digest(make(spark, texts).limit(0)).count() == 0
    kept = minhash.one_of_each(make(spark, texts)).collect()
    least = [i for i, (_, c) in brute_components(dict(rows).items(), 5, 80).items() if i == c]
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id is not None) == sorted((i, dict(rows)[i]) for i in least)
    assert [r.text for r in kept if r.doc_id is None] == ["no id"]


def test_minhash_equal_ids(spark):
    """Of documents that share an id, the linked one goes and the unlinked one stays."""
    rnd = random.Random(10)
    prose = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(100))
    linked, other, third, far = prose(), prose(), prose(), prose()
    rows = [(3, linked + " end"), (5, linked), (5, other), (5, third), (4, third + " end"), (9, third + " more"), (6, far), (2, far + " end")]
    got = {(r.doc_id, r.text_hash): (r.component_id, r.kept) for r in minhash.near_duplicates(make(spark, rows)).collect()}
    hashed = {r.text: r.h for r in make(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    want = {linked + " end": 3, linked: 3, other: 5, third: 4, third + " end": 4, third + " more": 4, far: 2, far + " end": 2}
    assert got == {(i, hashed[t]): (want[t], i == want[t]) for i, t in rows}
    assert sorted((r.doc_id, r.text) for r in minhash.one_of_each(make(spark, rows)).collect()) == sorted((i, t) for i, t in rows if i == want[t])


def test_minhash_large_group_near_the_threshold(spark, monkeypatch):
    """Copies edited here and there, similar by about the threshold, in buckets of several chunks."""
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(1000)}" for _ in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rnd.randrange(1, 7)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(minhash, "CHUNK", 16)
    want = brute_components(rows, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_digest(make(spark, rows)).collect()} == want


def test_least_matches_keeps_what_is_likely():
    for n in (28, 140):
        least = minhash.least_matches(n, 0.8, 1e-6)
        assert 0 < least < 0.8 * n
        # integral of the posterior above the threshold, by sums
        grid = [(k + 0.5) / 4000 for k in range(4000)]
        for m in (least - 1, least):
            weight = [s**m * (1 - s) ** (n - m) for s in grid]
            above = sum(w for s, w in zip(grid, weight, strict=True) if s >= 0.8) / sum(weight)
            assert (above >= 1e-6 * 0.9) == (m >= least) or abs(above / 1e-6 - 1) < 0.2


def brute_leaks(rows, items):
    def shingles(t):
        w = [x for x in re.split(r"[^\w]+|_", (t or "").lower()) if x]
        if not w:
            return []
        if len(w) < 5:
            return [("short", *w)]
        return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]

    def weight(s):
        return max(1, min(15, sum(map(len, s[1:] if s[0] == "short" else s)) // 4))

    out = set()
    for i, t in rows:
        doc = shingles(t)
        for j, item in items:
            own = shingles(item)
            full = sum(map(weight, set(own)))
            shares = [sum(map(weight, set(doc[s : s + len(own)]) & set(own))) / full for s in range(max(1, len(doc) - len(own) + 1))] if own and doc else []
            if shares and max(shares) >= 0.8:
                out.add((i, j, shares.index(max(shares)), round(max(shares), 9)))
    return out


def test_decontamination(spark, texts):
    rnd = random.Random(8)
    item = [f"q{rnd.randrange(500)}" for _ in range(40)]
    changed = list(item)
    changed[20] = "other"
    half = " ".join(item[:20])
    prose = lambda n: " ".join(f"z{rnd.randrange(10**6)}" for _ in range(n))
    rows = [*texts, (50, prose(30) + " " + " ".join(item).upper() + ". " + prose(9)), (51, " ".join(changed)), (52, half + " " + prose(50)), (53, "one TWO"), (54, " ".join(item) + " " + " ".join(item))]
    items = [(1, " ".join(item)), (2, "one, two"), (3, None), (4, ""), (5, " ".join(item)), (6, dict(t for t in texts if t[0])[11])]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("first_word", F.lit(1))
    got = {(r.doc_id, r.item_id, r.first_word, round(r.similarity, 9)) for r in decontam.leaks(make(spark, rows), bench).collect()}
    assert got == brute_leaks(rows, items)
    assert {(50, 1), (51, 1), (53, 2), (54, 5), (11, 6)} <= {x[:2] for x in got} and not {x for x in got if x[0] == 52}
    clean = decontam.decontaminate(make(spark, rows), bench)
    leaked = {x[0] for x in got}
    assert sorted([r.doc_id for r in clean.collect()], key=repr) == sorted([i for i, _ in rows if i not in leaked], key=repr)
    assert clean.columns == SCHEMA.replace(" bigint", "").replace(" string", "").replace(" double", "").replace(" int", "").replace(" boolean", "").split(", ")
    assert decontam.leaks(make(spark, rows).limit(0), bench).count() == 0
    assert decontam.leaks(make(spark, rows), bench.limit(0)).count() == 0


def test_decontamination_blocks_hold_the_radius():
    """Whatever ``RADIUS`` bits differ, some block differs by ``NEAR`` at most."""
    rnd = random.Random(2)
    for _ in range(2000):
        flipped = rnd.sample(range(decontam.BITS), decontam.RADIUS)
        assert min(sum(1 for b in flipped if b // decontam.WIDTH == k) for k in range(decontam.BLOCKS)) <= decontam.NEAR


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in pii.BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii(spark, texts):
    rnd = random.Random(6)
    noise = [(100 + k, "".join(rnd.choice("ab1234567890.@+-() _%é") for _ in range(200))) for k in range(150)]
    rows = [*texts, *noise, (98, "1" * 50000), (99, "1.2.3.4.5.6.7.8 0300.1.1.1 0255.0.0.1 a@b.c_d@e.f@g.h"), (97, "+1 " * 9000 + "a" * 50000 + "@")]
    want = []
    for i, t in rows:
        spans = brute_pii(t)
        n = Counter(s[0] for s in spans)
        want.append((i, n["email"], n["ip"], n["card"], n["phone"], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    got = pii.pii_digest(make(spark, rows))
    assert collected(got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) == sorted(want, key=repr)
    assert pii.pii_digest(make(spark, rows).limit(0)).count() == 0


def test_pii_checksums_and_context(spark):
    rows = [(1, "iban GB82WEST12345698765432 x"), (2, "GB82WEST12345698765431"), (3, "ssn 123-45-6789"), (4, "123-45-6789"), (5, "4111111111111111 and 4111111111111112")]
    got = {r.doc_id: r for r in pii.pii_digest(make(spark, rows)).collect()}
    assert got[1].spans == "iban:5:27" and got[2].spans == "" and got[3].spans == "ssn:4:15" and got[4].spans == "" and got[5].spans == "card:0:16"
    red = {r.doc_id: r for r in pii.redact(make(spark, [*rows, (6, None), (7, "mail a@b.co, é")])).collect()}
    assert red[1].text == "iban <IBAN> x" and red[5].text == "<CARD> and 4111111111111112" and red[6].text is None
    assert red[7].text == "mail <EMAIL>, é" and red[7].n_chars == 15


def test_pii_grouped_ibans(spark):
    rows = [
        (1, "pay GB82 WEST 1234 5698 7654 32 now"), (2, "BE68 5390 0754 7034 CODE WORD"), (3, "XBE68 5390 0754 7034"), (4, "BE68 5390 0754 7035"),
        (5, "MT84 MALT 0110 0001 2345 MTLC AST0 01S"), (6, "MT84MALT011000012345MTLCAST001S, BE68 5390 0754 7034"), (7, "é BE68 5390 0754 7034a BE68 5390 0754 7034"),
    ]
    made = make(spark, rows)
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("iban")] for r in pii.pii_digest(made).collect()}
    assert got == {1: ["iban:4:31"], 2: ["iban:0:19"], 3: [], 4: [], 5: ["iban:0:38"], 6: ["iban:0:31", "iban:33:52"], 7: ["iban:23:42"]}
    pdf = made.toPandas()
    con = duckdb.connect()
    con.register("documents", pdf)
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, spans FROM ({queries.SQL['op8_pii']})").fetchall()}
    assert want == {r.doc_id: r.spans for r in pii.pii_digest(made).collect()}
    assert pii.redact(made).where("doc_id = 6").first().text == "<IBAN>, <IBAN>"


def brute_redact(text, spans):
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_pii_many_matches_in_one_text(spark):
    rnd = random.Random(8)
    text = "".join(rnd.choice(["é", "mail ", "x" * 30, "\n"]) + rnd.choice(["a@b.co", "10.0.0.1", "4111111111111111", "+49 30 1234567"]) for _ in range(105_000))
    rows = [(1, text), (2, text[:300] * 3)]
    started = time.time()
    got = {r.doc_id: r for r in pii.pii_digest(make(spark, rows)).collect()}
    red = {r.doc_id: r for r in pii.redact(make(spark, rows)).collect()}
    assert time.time() - started < 120
    for i, t in rows:
        spans = brute_pii(t)
        assert got[i].base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)) and red[i].text == brute_redact(t, spans)
    assert len(brute_pii(text)) >= 100_000


def test_quality(spark, texts):
    larger = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality(documents(spark, larger), labels).collect()}
    marked = [(r.quality, got[r.doc_id]) for r in labels.collect()]
    held = [(y, r) for y, r in marked if r.held_out]
    good, bad = [r.score for y, r in held if y], [r.score for y, r in held if not y]
    assert sum(r.predicted == y for y, r in held) >= 0.88 * len(held)
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    dirty = quality.quality(make(spark, texts), labels.limit(0)).collect()
    assert len(dirty) == len(texts) and {r.score for r in dirty} == {0.5}
    twice = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (13, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.quality(make(spark, texts), twice).count() == len(texts)
    assert quality.quality(make(spark, texts).limit(0), labels).count() == 0


def test_secrets(spark, texts):
    rnd = random.Random(7)
    token = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    rows = [*texts, *((200 + k, f'some words token = "{token()}" more') for k in range(40)), *((300 + k, f"order 49529359002530{k:02} and thereinbefore12345678901") for k in range(40)), (400, f"é {token()} bare")]
    got = secret_scan.scan(make(spark, rows)).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    text = dict((i, t) for i, t in rows if i)
    for i, t in text.items():
        want = [(m.start(), m.end()) for m in re.finditer(secret_scan.CANDIDATE, t or "")]
        assert sorted((r.start, r.end) for r in by_doc.get(i, [])) == want
    assert all(r.sha256 == sha(text[r.doc_id][r.start : r.end]) for r in got)
    held = [r for r in got if r.label is not None]
    assert sum(r.is_secret == bool(r.label) for r in held) >= 0.95 * len(held)
    assert secret_scan.scan(make(spark, [(1, "abcdefghijklmnop1234")])).collect()[0].score == 0.5
    assert secret_scan.scan(make(spark, texts).limit(0)).count() == 0


def test_secrets_unquoted_short_and_without_digits(spark):
    """Spans written by hand: (text before, value, text after) of what is proposed; a named value is no sure false finding."""
    hexes, mixed = "24be64d6b2755a36d7d9c25bd72c4d5f67e061fd", "wJalrXUtnFEMIK7MDENGbPxRfiCYzzzzzzzzKEY9"
    cases = {
        1: ("API_KEY=", hexes, "\n"), 2: ("export AWS_SECRET_ACCESS_KEY=", mixed, ""), 3: ("GET /a?api_key=", hexes, "&page=2"),
        4: ('password = "', "hunter2hunter2", '"'), 5: ("PASSWORD=", "Zq!xv#kwpj", " next"), 6: ('{"client_secret": "', "qzxv wkjq pfgh", '", "a": 1}'),
        7: ("DB_PASSWORD: ", "xkq7", "."), 8: ("é 'auth_token' => '", "zxqwvkjh", "'"), 9: ("secret=", "QUJDREVGR0hJSktMTU5PUA==", ""), 10: ("n=", "abcdefghij1234==", " x"),
    }
    rows = [(i, "".join(parts)) for i, parts in cases.items()]
    rows += [(20, "the key: a b"), (21, "keyboard monkey"), (22, "n=12 m=ab"), (23, "token" * 20000), (24, "key=" * 3000)]
    rows += [(100 + k, "order 4952935900253000 and thereinbefore12345678901") for k in range(3)]
    docs = make(spark, rows)
    found = {}
    for r in secret_scan.candidates(docs).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.end, r.x))
    assert {i: found.get(i) for i in cases} == {i: [(len(a), len(a) + len(x), x)] for i, (a, x, _) in cases.items()}
    assert not {20, 21, 22, 23} & {*found}
    got = {r.doc_id: r.label for r in secret_scan.scan(docs).collect()}
    assert not [i for i in range(1, 10) if got[i] == 0] and got[1] == 1 and got[100] == 0
