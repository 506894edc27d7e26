"""Operators on documents: brute force on small tables, and the cases that tend to break."""

import array
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from holdfast.llm import langid, minhash, mixing, packing, passages, toxicity
from holdfast.llm.words import documents_of, lower_bytes, shingles, words_of

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Null text, empty, blanks, one word, a very long one, repeated rows, null id, lang and source."""
    long = " ".join(words(30_000, 1))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "One"), (5, long), (6, long), (6, long), (None, "no id here at all")]
    return [(i, t, None if i == 4 else "en", None if i in (2, 4) else f"s{(i or 0) % 2}", len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def odd(spark):
    # columns with names that operators use themselves
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.selectExpr("*", "'x' as size", "0 as start", "1 as block", "2 as node", "3 as seed", "4 as length", "5 as score")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- words -----------------------------------------------------------------------


def test_words_and_shingles_by_hand():
    text = "A bc\tD\x0b\x0c\r\n  é1 "
    s, e, h = words_of(lower_bytes(text))
    data = lower_bytes(text)
    assert [data[a:b].decode() for a, b in zip(s, e)] == ["a", "bc", "d", "é1"]
    assert len(set(h.tolist())) == 4 and (words_of(b"x bc")[2][1] == h[1])
    assert len(shingles(h, 4)) == 1 and len(shingles(h[:2], 4)) == 1 and len(shingles(h[:0], 4)) == 0
    long = b" ".join(b"w%d" % i for i in range(400_000))
    assert len(words_of(long)[0]) == 400_000


# --- mixing ------------------------------------------------------------------------


def test_water_fill():
    assert mixing.water_fill([10, 10], [1, 1], 20).tolist() == [10, 10]
    assert mixing.water_fill([1, 99], [1, 1], 100).tolist() == [3, 97]
    assert mixing.water_fill([0, 5], [9, 1], 5).tolist() == [0, 5]
    assert mixing.water_fill([], [], 0).tolist() == []


def test_permutation():
    for n in (1, 2, 3, 100, 1025):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 9, np.uint64))
        assert sorted(got.tolist()) == list(range(n))


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, " ".join(words(200 + i, i)), "en", f"s{i % 4}" if i % 9 else None, 0) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, mixing.mix_documents(df).collect()))
    assert got == sorted(map(tuple, mixing.mix_documents(df.repartition(7)).collect()))
    by = defaultdict(lambda: [0, 0.0, 0])
    source = {r[0]: r[3] for r in rows}
    for doc_id, size, total, target, taken in got:
        assert taken <= 3 * size and size == 200 + doc_id
        s = by[source[doc_id]]
        s[0], s[1], s[2] = s[0] + taken, target, s[2] + size
        assert total == sum(200 + i for i in source if source[i] == source[doc_id])
    for taken, target, size in by.values():
        assert abs(taken - target) <= mixing.BLOCK_WORDS * 2 and target <= 3 * size + 1e-6


def test_mix_of_small_sources(spark):
    """Sources of 1 to 200 words, beside a large one, meet their targets to a word or a hundredth."""
    sizes = [1, 2, 3, 5, 20, 25, 31, 40, 47, 60, 63, 64, 65, 90, 127, 128, 129, 150, 200, 9000]
    rows = [(i, " ".join(words(n, i)), "en", f"s{i:02d}", 0) for i, n in enumerate(sizes)]
    got = mixing.mix_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(sizes)
    for r in got:
        assert abs(r["taken"] - r["target"]) <= max(1, 0.02 * r["target"]) and r["taken"] <= 3 * r["size"], r


def test_mix_odd_rows(odd, empty):
    got = mixing.mix_documents(odd).collect()
    assert len(got) == 8 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert [r["taken"] for r in got if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert mixing.mix_documents(empty).count() == 0


def test_mixed_texts_hold_what_is_taken(spark):
    rows = [(i, " \n ".join(words(90 + i, i)), "en", f"s{i % 3}", 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_documents(df).collect()}
    got = defaultdict(int)
    for r in mixing.mixed_texts(df).collect():
        got[r["doc_id"]] += len(r["text"].split())
        assert set(r["text"].split()) <= set(rows[r["doc_id"]][1].split()) and r["n_chars"] == len(r["text"])
    assert {i: n for i, n in taken.items() if n} == dict(got)


def test_texts_of_the_mix_are_written_once(spark, monkeypatch):
    """Repeated ids, of equal and of other texts, and rows without id or source keep the places of rows of their own."""
    written = []

    def spy(df):
        written.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df)

    plain = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", spy)
    text = [" ".join(words(300, k)) for k in range(4)]
    rows = [(1, text[0]), (1, text[0]), (1, text[1]), (None, text[2]), (None, text[2]), (2, text[3]), (3, None), (4, " ")]
    df = spark.createDataFrame([(i, t, "en", "s" if i else None, 0) for i, t in rows], SCHEMA)
    got = mixing.mixed_texts(df).collect()
    with_text = [plan for columns, plan in written if "text" in columns]
    assert len(with_text) == 1 and "Exchange" not in with_text[0]
    taken = mixing.mix_documents(df).collect()
    assert sum(len(r["text"].split()) for r in got) == sum(r["taken"] for r in taken) > 0
    by = {i: {w for j, t in rows if j == i for w in (t or "").split()} for i in (1, 2, None)}
    assert all(set(r["text"].split()) <= by[r["doc_id"]] for r in got)


# --- language ----------------------------------------------------------------------


def test_language_of_held_out_rows(spark, sf):
    docs = documents_of(spark.read.parquet(f"{sf}/documents.parquet"), "lang")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.op2_language_id(spark, sf).where("held_out").collect()
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(odd, empty, spark):
    docs = documents_of(odd, "lang")
    model = langid.fit(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[5] == "en"
    none = langid.fit(documents_of(empty, "lang"))
    assert langid.predict(docs, none).where("lang_pred = 'und'").count() == 8
    assert langid.predict(documents_of(empty, "lang"), none).count() == 0


# --- near duplicates -----------------------------------------------------------------


def brute_components(rows, k, percent):
    def sets(text):
        w = lower_bytes(text or "").split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    s = [sets(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    return sorted(((rows[i][0], len(s[i]), least[root[i]]) for i in range(len(rows))), key=repr)


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 8)  # families over several blocks
    r, rows = random.Random(4), []
    for family in range(8):
        base = words(80, 100 + family)
        for _ in range(25):
            copy = list(base)
            for _ in range(r.randrange(6)):
                copy[r.randrange(80)] = f"x{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(base).upper()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((4, 80), (5, 80)):
        got = minhash.near_duplicates(df, k, percent).collect()
        assert sorted(((g[0], g[1], g[2]) for g in got), key=repr) == brute_components(rows, k, percent)
        assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)


def test_near_duplicates_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 64)  # buckets over several blocks
    draw = np.random.default_rng(6)
    briefs = draw.integers(0, 256, (400, 200), dtype=np.uint8)
    briefs[:, :84] = briefs[0, :84]  # 0.42 alike, by two
    for i in range(0, 40, 2):  # and 0.8
        briefs[i + 1, :160] = briefs[i, :160]
    rows = [(i, list(range(40)), bytearray(b.tobytes())) for i, b in enumerate(briefs)]  # all in the same buckets
    found = minhash._families(spark.createDataFrame(rows, "node long, bands array<long>, brief binary")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: i // 2 * 2 for i in range(40)}


def test_near_duplicates_odd_rows(odd, empty):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = minhash.near_duplicates(odd).collect()
    assert sorted(((g[0], g[1], g[2]) for g in got), key=repr) == brute_components(rows, 4, 80)
    assert minhash.near_duplicates(empty).count() == 0


def test_min_max_estimates_similarity():
    draw = np.random.default_rng(0)
    common, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = (minhash.min_max(np.unique(np.concatenate((common, z)))) for z in (a, b))
    assert len(x) == 200 and abs((x == y).mean() - 0.8) < 0.1


# --- passages ------------------------------------------------------------------------


def test_passages_are_found_and_others_left(spark):
    shared = words(80, 7)
    fuzzy = list(shared)
    fuzzy[40] = "changed"
    texts = {
        1: words(200, 11) + shared + words(100, 12),
        2: words(60, 13) + shared + words(150, 14),
        3: words(90, 15) + fuzzy,
        4: words(300, 16),
        5: words(50, 17) + shared[:30] + words(50, 18),
    }
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in passages.repeated_passages(df).collect()}
    assert set(got) == {2, 3}
    assert (got[2]["start"], got[2]["end"], got[2]["source_doc_id"], got[2]["source_start"]) == (60, 140, 1, 200)
    assert (got[3]["start"], got[3]["end"], got[3]["matches"]) == (90, 170, 79)
    full = df.selectExpr("*", "'en' lang", "'s' source", "0L n_chars")
    cut = {r["doc_id"]: r["text"].split() for r in passages.without_passages(full, passages.repeated_passages(full)).collect()}
    assert cut[2] == texts[2][:60] + texts[2][140:] and cut[3] == texts[3][:90]
    assert all(cut[i] == texts[i] for i in (1, 4, 5))


def test_passages_parted_by_different_words_are_all_found(spark):
    texts, want = {}, {}
    for n, (mine, theirs) in enumerate([(10, 10), (40, 40), (100, 100), (200, 200), (500, 500), (10, 200), (200, 10), (0, 300), (500, 0)]):
        one, two = words(60, 1000 + n), words(60, 1100 + n)
        texts[2 * n] = words(70, 1200 + n) + one + words(theirs, 1300 + n) + two + words(70, 1400 + n)
        texts[2 * n + 1] = words(90, 1500 + n) + one + words(mine, 1600 + n) + two + words(90, 1700 + n)
        want[2 * n + 1] = set(range(90, 150)) | set(range(150 + mine, 210 + mine))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = defaultdict(set)
    for r in passages.repeated_passages(df).collect():
        assert r["source_doc_id"] == r["doc_id"] - 1 and r["end"] - r["start"] >= 50 and r["identity"] >= 0.8
        got[r["doc_id"]] |= set(range(r["start"], r["end"]))
    assert set(got) == set(want)
    for i, places in want.items():
        assert places <= got[i] and len(got[i] - places) <= 30  # a short gap may be bridged


def test_passages_with_many_changed_words_are_found(spark):
    rows, edits = [], {}
    for n, step in enumerate([5, 6, 8, 10, 15] * 8):
        shared = words(100, 2000 + n)
        other = [f"x{n}-{i}" if i % step == n % step else w for i, w in enumerate(shared)]
        rows.append((2 * n, " ".join(words(80, 2100 + n) + shared + words(80, 2200 + n))))
        rows.append((2 * n + 1, " ".join(words(70, 2300 + n) + other + words(70, 2400 + n))))
        edits[2 * n + 1] = step
    got = defaultdict(int)
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["source_doc_id"] == r["doc_id"] - 1 and r["identity"] >= 0.8
        got[r["doc_id"]] += r["end"] - r["start"]
    assert set(got) == set(edits) and min(got.values()) >= 90


def test_passages_of_parts_with_other_owners(spark):
    texts, want = {}, {}
    for n in range(30):
        size, number = ((30, 2), (12, 5), (40, 2), (24, 3), (49, 9))[n % 5]
        parts = [words(size, 5000 + 10 * n + i) for i in range(number)]
        whole = [w for part in parts for w in part]
        for i, part in enumerate(parts):  # each part is first held by a document of its own
            texts[20 * n + i] = words(60, 6000 + 20 * n + i) + part + words(60, 7000 + 20 * n + i)
        texts[20 * n + 10] = words(70, 8000 + n) + whole + words(70, 8100 + n)
        texts[20 * n + 11] = words(50, 8200 + n) + whole + words(90, 8300 + n)
        want[20 * n + 11] = (50, 50 + len(whole), 20 * n + 10)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = passages.repeated_passages(df).collect()
    assert {r["doc_id"]: (r["start"], r["end"], r["source_doc_id"]) for r in got} == want


def test_chains_against_all_predecessors():
    draw = np.random.default_rng(3)
    for _ in range(30):
        n = int(draw.integers(2, 14))
        rows = np.stack((draw.integers(0, 60, n), draw.integers(0, 60, n), draw.integers(2, 9, n)), axis=1)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        best = [0.0] * n
        for i, (s, t, w) in enumerate(rows):
            best[i] = float(w)
            for j, (a, b, v) in enumerate(rows[:i]):
                if a + v <= s and b + v <= t:
                    best[i] = max(best[i], w + best[j] - passages.GAP_COST * ((s - a - v) + (t - b - v)))
        c = passages.chains(rows)
        first = rows[c[0]]
        gaps = sum((y[0] - x[0] - x[2]) + (y[1] - x[1] - x[2]) for x, y in zip(first, first[1:]))
        assert abs(first[:, 2].sum() - passages.GAP_COST * gaps - max(best)) < 1e-9
        assert sorted(i for x in c for i in x) == list(range(n))


def test_passages_odd_rows(odd, empty):
    got = passages.repeated_passages(odd).collect()
    assert {r["doc_id"] for r in got} == {6} and sum(r["end"] - r["start"] for r in got) >= 29_000
    assert passages.repeated_passages(empty).count() == 0


# --- toxicity ------------------------------------------------------------------------


def channel():
    counts = np.zeros((toxicity.SIZE,) * 3)
    for w in ["idiot", "stupid", "the", "is", "you", "are", "hello", "book", "good"] * 200:
        c = [0, *toxicity.classes_of(w).tolist(), 0]
        for x, y, z in zip([0, *c], c, c[1:]):
            counts[x, y, z] += 1
    return toxicity.Channel.of(counts)


def test_restores_hidden_words():
    c = channel()
    for hidden in ("1d10t", "i d i o t", "idiooooot", "i.d.i.o.t", "!d!ot", "IDI0T"):
        assert c.restore(f"you are {hidden} hello") == "you are idiot hello"
    for clean in ("the good book", "page 12 of 300", "a b", ""):
        assert c.restore(clean) == clean


def test_restores_hidden_words_beside_punctuation():
    c = channel()
    for hidden in ("1d10t", "i d i o t", "i.d.i.o.t", "i d 1 0 t", "1.d.i.0.t", "IDI0T"):
        for before, after in (("", ","), ("", "."), ('"', '"'), ("'", "',"), ("", "?"), ("\u201c", "\u201d."), ("[", "];")):
            assert c.restore(f"you are {before}{hidden}{after} hello") == f"you are {before}idiot{after} hello"
    assert c.restore("y o u are 5tup1d, 1d10t.") == "you are stupid, idiot."
    assert "0" not in c.restore("1d10t" * 20)
    assert len(c.restore("a" + "12" * 20_000 + "b")) > 0
    for clean in ("the (good) book, page 12, 300.", "3.14 is 2 3 4"):
        assert c.restore(clean) == clean


def test_toxicity_of_held_out_rows(spark, tmp_path):
    bad, rows, labels = ["idiot", "scum", "moron"], [], []
    r = random.Random(2)
    for i in range(400):
        toxic = i % 4 == 0
        w = words(60, i, 300)
        if toxic:
            w[r.randrange(60)] = r.choice(bad) if i % 8 else "1d1ot"
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).where("held_out").collect()
    assert np.mean([g["predicted"] == (g["doc_id"] % 4 == 0) for g in got]) > 0.9


def test_toxicity_odd_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, None), (4, 1), (4, 0), (5, 0), (None, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        got = toxicity.score(documents_of(odd), toxicity.fit(documents_of(odd), labels)).collect()
        assert len(got) == 8 and all(0 <= g["score"] <= 1 for g in got)
    assert toxicity.score(documents_of(empty), toxicity.fit(documents_of(empty), none)).count() == 0


# --- packing -------------------------------------------------------------------------


def test_best_fit_against_a_plain_search():
    r = random.Random(1)
    for capacity in (7, 64, 2048):
        lengths = sorted((r.randrange(1, capacity + 1) for _ in range(300)), reverse=True)
        left, want = [], []
        for n in lengths:
            fits = [x for x in left if x >= n and n < capacity]
            if fits:
                left.remove(min(fits))
                left.append(min(fits) - n) if min(fits) > n else None
            else:
                want.append(n)
                left.append(capacity - n) if capacity > n else None
        got = packing.best_fit_decreasing(lengths, capacity)
        assert len({b for b, _ in got}) == len(want)
        ends = defaultdict(int)
        for (b, o), n in zip(got, lengths):
            assert o == ends[b]
            ends[b] += n
        assert max(ends.values()) <= capacity


def test_pieces_round_trip(spark, odd):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = ["Don't STOP, it's <|endoftext|> fine!!", "É à Über straße x ﬁ İstanbul ΣΑΣ", "Á 1234 $$$ a_b", "x" * 50_000]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(texts, 50)), "doc_id long, text string"))
    got, seqs = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(df, path).collect():
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for r in df.collect():
        ids = array.array("I", [*t.encode(r["text"] or "", add_special_tokens=False).ids, 0])
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[r["doc_id"]].append((p, at, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for held in seqs.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 2048


def test_pack_nothing(empty):
    assert packing.pack_documents(empty, P.path("word_bpe_49k.json")).count() == 0


# --- pipeline ------------------------------------------------------------------------


def test_one_row_of_each_group_stays(spark, empty):
    """Repeated ids, with equal and with other texts; a copy under a larger id; rows without id or text."""
    text = {k: " ".join(words(60, k)) for k in range(4)}
    rows = [(1, text[0]), (1, text[0]), (2, text[0]), (3, text[1]), (3, text[2]), (3, None), (4, text[3]), (5, None), (None, text[3]), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "").collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5] and ids.count(None) == 2
    by = {r["doc_id"]: r["text"] for r in got if r["doc_id"] is not None}
    assert by == {1: text[0], 3: min(text[1], text[2]), 4: text[3], 5: None}
    assert corpus_pipeline.drop_near_duplicates(spark, empty, "").count() == 0


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() > 0, name
    assert corpus_pipeline.run(spark, sf).count() >= docs.count()
