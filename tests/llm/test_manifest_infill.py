"""The Merkle manifest and the fill-in-middle transformation against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm import infill, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"Wörd{i}" for i in range(200_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "de", "a", 0),
        (3, "A b\n1 ", "de", None, 6),
        (3, "A b\n1 ", "de", None, 6),
        (3, "Another text of one id", "de", None, 22),
        (None, "No id", "de", "x", 5),
        (None, "No id", "de", "x", 5),
        (7, "holds <M> already", "", "x", 17),
        (8, long, "ü", "x", len(long)),
        (9, "naïve ÄÖ 日本 x", "ü", "x", 13),
        (-5, "below zero", "ü", "x", 10),
    ]
    return rows + [(100 + i, f"Text {i} of Many, <P", "zz" if i % 3 else "de", "s", 9) for i in range(150)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    return df.selectExpr("*", "1 as idx", "'q' as g", "2 as n", "'d' as digest", "0 as _at", "'f' as form", "3 as output")


# --- Merkle manifest ------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    fields = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return sha("".join(fields))


def proof_and_top(digests, fanout):
    """Per place [(left, right), ...], and the top, of a list of digests."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, place in enumerate(at):
            start = place - place % fanout
            run = digests[start : start + fanout]
            paths[k].append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
            at[k] = place // fanout
        digests = [sha("".join(digests[i : i + fanout])) for i in range(0, len(digests), fanout)]
    return paths, digests[0]


def brute_manifest(rows, fanout):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), text, source, n_chars))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    subs, low = [], {}
    for lang in langs:
        groups[lang].sort(key=lambda r: r[:3])
        low[lang], top = proof_and_top([r[2] for r in groups[lang]], fanout)
        subs.append(top)
    high, root = proof_and_top(subs, fanout)
    out = []
    for lang, above, sub in zip(langs, high, subs):
        for row, path in zip(groups[lang], low[lang]):
            known, number, own, text, source, n_chars = row
            doc_id = number if known else None
            cur = own
            if known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                cur = leaf(doc_id, source, lang, n_chars, text.translate(lower))
            proof = sha("".join(a + b for a, b in path + above))
            for a, b in path + above:
                cur = sha(a + cur + b)
            out.append((doc_id, own, sub, root, proof, cur, cur == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [8, 2, 3])
def test_manifest_equals_plain_python(odd, fanout, monkeypatch):
    monkeypatch.setattr(merkle, "_ROWS", 20)  # several ranges of leaves
    got = sorted((tuple(r) for r in merkle.proofs(odd, fanout).collect()), key=repr)
    want = brute_manifest(odd_rows(), fanout)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_small_tables(spark):
    assert merkle.proofs(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(4, "Alone", "en", None, 5)]
    assert [tuple(r) for r in merkle.proofs(spark.createDataFrame(one, SCHEMA)).collect()] == brute_manifest(one, 8)
    same = [(6, "Same row", "en", "s", 8)] * 70
    got = sorted((tuple(r) for r in merkle.proofs(spark.createDataFrame(same, SCHEMA)).collect()), key=repr)
    assert got == brute_manifest(same, 8)


def test_rows_are_numbered_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_ROWS", 50)
    rows = [("a" if i % 10 else "b", (i * 7919) % 1000, "x") for i in range(1000)] + [("a", None, "x")] * 300
    got = merkle.numbered(spark.createDataFrame(rows, "g string, doc_id long, rest string"), "g", "doc_id").collect()
    for g in "ab":
        part = sorted((r for r in got if r["g"] == g), key=lambda r: r["idx"])
        assert [r["idx"] for r in part] == list(range(len(part))) and {r["n"] for r in part} == {len(part)}
        ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in part]
        assert ids == sorted(ids)


# --- fill-in-middle -------------------------------------------------------------------


def brute_infill(doc_id, text, seed=1):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transformed_table(odd):
    got = infill.fill_in_middle(odd).collect()
    assert sorted((r[0], *r[2:]) for r in got if r[0] is not None) == sorted(
        (i, *brute_infill(i, t or "")) for i, t, *_ in odd_rows() if i is not None
    )
    assert [tuple(r[2:]) for r in got if r[0] is None] == [brute_infill(None, "No id")] * 2
    back = infill.restored(infill.fill_in_middle(odd)).collect()
    assert sorted((repr(r["doc_id"]), r["restored"]) for r in back) == sorted((repr(i), t or "") for i, t, *_ in odd_rows())


def test_empty_table(spark):
    assert infill.restored(infill.fill_in_middle(spark.createDataFrame([], SCHEMA))).count() == 0


texts = st.text(alphabet=st.sampled_from(list("ab<>PSM Zé日\n😀")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(texts, st.tuples(*[st.integers(0, 2**32 - 1)] * 4))
def test_any_text_comes_back(text, h):
    data = text.encode()
    n, form, before, inside, out = infill.transform(data, list(h))
    assert n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text))
    assert infill.restore(out, form) == data
    if form != "plain":
        p, m, s = infill.PREFIX.decode(), infill.MIDDLE.decode(), infill.SUFFIX.decode()
        first, mid, last = text[:before], text[before : before + inside], text[before + inside :]
        assert out.decode() == (f"{s}{last}{p}{first}{m}{mid}" if form == "spm" else f"{p}{first}{s}{last}{m}{mid}")


def test_rotation_of_every_size():
    for n in range(9):
        for i in range(n + 1):
            for m in range(i, n + 1):
                for j in range(m, n + 1):
                    buf = np.arange(n, dtype=np.uint8)
                    want = [*range(i), *range(m, j), *range(i, m), *range(j, n)]
                    infill.rotate(buf, i, m, j)
                    assert buf.tolist() == want
