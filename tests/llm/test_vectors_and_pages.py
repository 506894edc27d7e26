"""Operators on vectors and pages: brute force, round trips, odd rows."""

import gzip
import hashlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import ann, html, topk, warc

NAN, INF = float("nan"), float("inf")


def vectors(spark, n=400, seed=0):
    draw = np.random.default_rng(seed)
    m = draw.normal(size=(n, 8)).round(2)
    m[::7] = m[0]  # many equal ones
    rows = [(i, m[i].tolist()) for i in range(n)] + [(20, m[3].tolist()), (100, m[5].tolist())]
    rows += [(900, None), (920, [1.0, None]), (940, [NAN] * 8), (960, [INF] * 8), (980, [0.0] * 8), (None, m[1].tolist())]
    # `rank` and `score` are columns of the result as well
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x")), rows


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 90)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    df, rows = vectors(spark)
    v = topk.integer_vectors(df)
    got = sorted((r["query_id"], r["rank"], r["score"], r["vec_id"]) for r in topk.exact_top_k(v, v.where("vec_id % 20 = 0"), 10).collect())
    good = [(i, [int(np.floor(1024 * x)) for x in e]) for i, e in rows if e and all(x is not None and np.isfinite(x) for x in e)]
    want = []
    for q, (i, e) in enumerate(good):
        if i is not None and i % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(e, f)), 2**63 if j is None else j) for c, (j, f) in enumerate(good) if c != q]
            want += [(i, r, -s, None if j == 2**63 else j) for r, (s, j) in enumerate(sorted(scored)[:10], 1)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_top_k_of_few_and_none(spark):
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    for df in (one, one.limit(0)):
        v = topk.integer_vectors(df)
        assert topk.exact_top_k(v, v, 5).count() == 0
        assert ann.nearest(ann.usable(df), F.lit(True), 5).count() == 0


def test_pruning_loses_nothing():
    draw = np.random.default_rng(1)
    c, q = draw.integers(-900, 900, (32, 500)), draw.integers(-900, 900, (32, 6))
    c[:, 100:140] = c[:, :1]
    ids = draw.permutation(500)
    for j, places in enumerate(topk.branch_and_bound(q, c, ids, 7, 4)):
        order = np.lexsort((ids, -(q[:, j] @ c)))[:7]
        assert places.tolist() == order.tolist()


def test_forest_recall_and_scores(spark):
    df, rows = vectors(spark, 600, 4)
    good = [(i, e) for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    got = ann.nearest(ann.usable(df), F.col("vec_id") % 20 == 0, 20).collect()
    queries = [(i, e) for i, e in good if i % 20 == 0]
    assert len(got) == 20 * len(queries)
    hits = total = 0
    for i, e in {i: e for i, e in queries if [x for x, _ in queries].count(i) == 1}.items():
        scored = sorted((-(np.array(e) * f).sum(), j) for j, f in good if j != i)[:20]
        mine = sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        hits += len({j for _, j in scored} & {r["vec_id"] for r in mine})
        total += 20
    assert hits / total >= 0.9


# --- WARC ------------------------------------------------------------------------------


def test_ranges_own_their_records():
    nested = warc.encode(9, "u", b"inner" * 50, "d", False, None)
    payloads = [b"", b"x" * 99, nested * 2, bytes(range(256)) * 40, b"\x1f\x8b\x08 no member", "é\r\n\r\nWARC/1.1".encode()]
    members = [warc.encode(i, f"http://h/{i}\n%0A", p, hashlib.sha256(p).hexdigest(), False, None) for i, p in enumerate(payloads * 5)]
    data = b"".join(members)
    assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type") >= len(members)
    for split in (1, 7, 100, 1000, len(data)):
        found = [x for low in range(0, len(data), split) for x in warc.records_in(io.BytesIO(data), len(data), low, min(len(data), low + split))]
        assert [warc.decode(x)[2] for x in found] == payloads * 5


def test_round_trip(spark):
    long, short = "<p>" + "é" * 200, "tiny"
    rows = [(5, "u5", long), (3, None, long), (3, None, long), (1, "u1", short), (2, "u2", short), (7, "u7", None),
            (8, "u8", ""), (None, "n", long), (9, "u\n9 ", "y" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("bytes", F.lit(2))
    got = sorted(map(tuple, warc.round_trip(df, payload=True).collect()), key=repr)
    assert len(got) == len(rows)
    by = {}
    for page, url, n, digest, kind, refers, body in got:
        by.setdefault(page, []).append((kind, refers))
        html_ = next(h for p, u, h in rows if p == page) or ""
        assert (n, digest) == (len(html_.encode()), hashlib.sha256(html_.encode()).hexdigest())
        assert (body is None) == (kind == "revisit") and (body is None or bytes(body) == html_.encode())
        assert (page, url) in [(p, u) for p, u, _ in rows]
    assert sorted(by[3], key=repr) == [("response", None), ("revisit", 3)]
    assert by[5] == by[None] == [("revisit", 3)]
    assert all(by[i] == [("response", None)] for i in (1, 2, 7, 8, 9))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_files_are_kept_apart_by_range(spark):
    df = spark.range(300).selectExpr("id as page_id", "'u' as url", "repeat(uuid(), 30) as html")
    folder = warc.shared_folder(spark).rstrip("/") + "/warc-split"
    manifest = warc.write(df.repartition(2), folder)
    assert warc.read(manifest, folder, split=5000).select("page_id").distinct().count() == 300
    assert warc.read(manifest, folder, split=5000).count() == 300


# --- HTML ------------------------------------------------------------------------------

BODY = "".join(f"<p>Paragraph {i} of the story, long enough to carry some text.</p>" for i in range(6))
LINES = [f"Paragraph {i} of the story, long enough to carry some text." for i in range(6)]


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a>Home</a></nav><article><h1>T &amp; x</h1>{BODY}</article><footer>(c)</footer>",
        f"<header><h1>Site</h1></header><div class='sidebar'><p>Other</p></div><main><h1>T &#38;\n x</h1>{BODY}</main>",
        f"<div id=menu><ul><li>One<li>Two</ul></div><div class=content><h2>T &amp;  x</h2>{BODY}</div><div class='ad'>Buy</div>",
        f"<article><h1>T<br>&amp; <b>x</b></h1><script>var a='</p>'</script>{BODY}<aside>See</aside><form><p>Name</p></form>"
        "</article><div class='comments'><p>First reader comment, it is rather long as well.</p></div>",
        f"<div class='cookie-notice'><p>We use cookies</p></div><article><h1>T &amp; x{BODY}",
    ],
)
def test_main_text(page):
    assert html.main_text(page).split("\n") == ["T & x", *LINES]


@pytest.mark.parametrize(
    "between",
    ["<div class=ad><p>Buy now</p></div>", "<button>Share</button>", "<form><p>Your name</p><input></form>",
     "<p>Paragraph 9 <span class=social>tweet</span></p>", "<div class='newsletter'><p>Sign up</p></div><aside>See also</aside>"],
)
def test_text_goes_on_behind_stripped_elements(between):
    more = "".join(f"<p>More {i} of the same story, it goes on.</p>" for i in range(4))
    page = f"<body><div class=menu>Home</div><div class=content>{BODY}{between}{more}{between}<p>The end.</p></div><div><p>Elsewhere</p></div>"
    got = html.main_text(f"<html>{page}</html>").split("\n")
    extra = ["Paragraph 9"] if "Paragraph" in between else []
    assert got[: len(LINES)] == LINES and [x for x in got if x.startswith("More")] == [f"More {i} of the same story, it goes on." for i in range(4)]
    assert "The end." in got and got.count("Paragraph 9") == 2 * len(extra) and not {"Buy now", "Share", "Your name", "tweet", "Sign up"} & set(got)


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body><article>{BODY}</article>",
        f"<head><title>T</title><style>p {{}}</style></head><body><svg viewBox='0 0 1 1'/><article>{BODY}</article>",
        f"<div class='content with-sidebar'>{BODY}</div><div class=sidebar><p>Other</p></div>",
        f"<div class='no-sidebar'><article>{BODY}</article></div>",
        f"<div id=page-header-wrap><p>Site</p><article>{BODY}</article></div>",
        f"<div class='story side'>{BODY}</div><div class=menu>Home</div>",
        f"<div class=content>{BODY}</div><article class=teaser><p>Read on</p></article>",
        f"<div class=content>{BODY}</div><article class=comment>{'<p>I think so too, and at great length.</p>' * 30}</article>",
    ],
)
def test_whole_articles_of_valid_pages(page):
    assert html.main_text(page).split("\n")[-6:] == LINES


def test_pages_of_the_given_tables(spark, sf):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: r for r in html.op7_html_extraction(spark, sf).collect()}
    for p in pages:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", p["html"], re.S)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<(?!/?(?:p|h1)>)[^>]*(?:>|\Z)", " ", article[1])) if article else []
        want = [x for x in (" ".join(unescape(b).split()) for b in blocks) if x]
        assert got[p["page_id"]]["text"] == "\n".join(want) and got[p["page_id"]]["n_chars"] == len("\n".join(want))


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words"), (4, "u", "<<<>>"), (None, "u", "<p>" * 5000 + "deep"), (3, "u", "plain words")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [r["text"] for r in html.extract(df.coalesce(1)).collect()]
    assert got[:3] == ["", "", "plain words"] and got[4:] == ["deep", "plain words"]
    assert html.extract(df.limit(0)).count() == 0
