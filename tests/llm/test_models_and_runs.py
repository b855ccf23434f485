"""Line runs, the language model and web pages against brute force, and odd rows."""

import math
import os
import random
from collections import Counter

import brute
import numpy as np
import pytest

from tallyloom.llm import html_blocks, html_extraction, language_model, line_runs
from tallyloom.llm import queries as _  # noqa: F401
from tallyloom.llm.html_blocks import blocks_of
from tallyloom.llm.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def deleted_lines(rows, min_words):
    """From each line the longest run that equals one at an earlier place; runs of enough words lose all their lines."""
    texts, at = {}, {}
    for n, (doc, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        lines = text.split("\n") if text is not None else []
        texts[n] = lines
    gone = {n: set() for n in texts}
    words = {n: [len(brute.WORD.findall(x)) for x in lines] for n, lines in texts.items()}
    for n, lines in texts.items():
        for i, line in enumerate(lines):
            best = 0
            for m, j in at.get(line, []):
                k = 0
                while i + k < len(lines) and j + k < len(texts[m]) and lines[i + k] == texts[m][j + k]:
                    k += 1
                best = max(best, k)
            if sum(words[n][i : i + best]) >= min_words:
                gone[n].update(range(i, i + best))
            at.setdefault(line, []).append((n, i))
    return gone


def check_runs(spark, rows, min_words):
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(rows)], "n long, doc_id long, text string").coalesce(1)
    gone = deleted_lines(rows, min_words)
    got = line_runs.dedup(df, min_words).collect()
    assert len(got) == len(rows)
    for r in got:
        text, cut = rows[r["n"]][1], gone[r["n"]]
        lines = text.split("\n") if text is not None else []
        want = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)
        assert r["text"] == want and r["n_deleted"] == len(cut) and r["n_lines"] == len(lines)
        spans = [tuple(map(int, s.split(":"))) for s in r["deleted_runs"].split(",") if s]
        assert {i for a, b in spans for i in range(a, b)} == cut
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))  # maximal


@pytest.mark.parametrize("min_words", [1, 3, 9])
def test_random_line_runs(spark, min_words):
    rng = random.Random(min_words)
    stock = ["a", "b c", "d e f", "", " ", "g h i j", "k"]
    rows = [(rng.choice([None, rng.randrange(9)]), "\n".join(rng.choice(stock) for _ in range(rng.randrange(25)))) for _ in range(25)]
    check_runs(spark, rows + [(3, None), (4, ""), (5, "a\n" * 40)], min_words)


def test_line_runs_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check_runs(spark, rows, 50)
    assert QUERIES["op3_line_runs"](spark, SF_DIR).count() == len(rows)


def test_whole_runs_go(spark):
    """The last lines of a copy go with it, though they hold few words; blank lines in between count as lines."""
    say = lambda n, tag: " ".join(f"{tag}{i}" for i in range(n))
    a, b = say(60, "a"), say(30, "b")
    c, d, e = say(25, "c"), say(25, "d"), say(20, "e")
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{b}"), (3, f"{c}\n{d}\n{e}"), (4, f"x\n{c}\n{d}\n{e}\ny"), (5, f"{a}\n{e}\n{b}"), (6, f"{a}\n{e}\nz")]
    rows += [(7, f"{a}\n\n\n{b}\n\nq"), (8, f"{a}\n\n\n{b}\n\nr"), (9, "\n".join([a] * 4 + [b])), (10, a)]
    check_runs(spark, rows, 50)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["text"], r["deleted_runs"]) for r in line_runs.dedup(df, 50).collect()}
    assert got[2] == ("", "0:2") and got[4] == ("x\ny", "1:4") and got[6] == ("z", "0:2") and got[8] == ("r", "0:5")


def test_line_runs_keep_columns(spark):
    df = spark.createDataFrame([(1, "a b", "old", 7)], "doc_id long, text string, deleted_runs string, row int")
    assert line_runs.dedup(df, 1).columns == ["doc_id", "row", "text", "n_lines", "n_deleted", "deleted_runs"]
    assert line_runs.dedup(df.limit(0), 1).count() == 0


def slow_ppm(texts, order):
    """A dictionary of counts and the probability of a symbol in a context, by the same rules."""
    counts = [{} for _ in range(order + 1)]
    for t in texts:
        s = [256] * order + list(t) + [256]
        for i in range(order, len(s)):
            for k in range(order + 1):
                c = counts[k].setdefault(tuple(s[i - k : i]), Counter())
                c[s[i]] += 1

    def probability(context, symbol):
        p, excluded = 1.0, set()
        for k in range(order, -1, -1):
            by = counts[k].get(tuple(context[order - k :]) if k else ())
            if not by:
                continue
            whole = sum(n + 1 for s, n in by.items() if s not in excluded)
            if symbol in by:
                return p * by[symbol] / whole
            left = len(by) - len(excluded)
            p *= left / whole if left else 1
            excluded = set(by)
        return p / max(257 - len(excluded), 1)

    return probability


def codes_of(texts, order):
    return Counter(language_model.grams(texts, order)[0].tolist())


@pytest.mark.parametrize("order", [0, 1, 3, 5])
def test_probabilities_equal_the_slow_version(spark, order):
    """Of learned grams, grams of unknown contexts and of unseen bytes; of one context they add up to one."""
    rng = random.Random(order)
    draw = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(60))).encode()
    learned = [draw("abcde ") for _ in range(40)] + [b"", "é\x00ÿ".encode()]
    asked = [draw("abcdefz ") for _ in range(30)] + [b"", b"zzz", b"\xff"]
    n = codes_of(learned, order)
    contexts = [[256] * order, [98, 97, 99, 97, 98][:order], [121] * order]
    every = []
    for c in contexts:
        high = sum(b << 9 * (i + 1) for i, b in enumerate(c))
        every.append([high | s for s in range(257)])
    codes = set(n) | set(codes_of(asked, order)) | {x for row in every for x in row}
    df = spark.createDataFrame([(c, n.get(c, 0), c % 7) for c in sorted(codes)], "code long, n long, bucket long").repartition(3)
    got = {r["code"]: r["logp"] for r in language_model.log_probabilities(df, order).collect()}
    assert set(got) == codes
    slow = slow_ppm(learned, order)
    for c in codes:
        symbols = [c >> 9 * i & 511 for i in range(order + 1)]
        assert abs(got[c] - math.log(slow(symbols[1:], symbols[0]))) < 1e-9
    for row in every:
        assert abs(sum(math.exp(got[c]) for c in row) - 1) < 1e-9


def test_scores_equal_the_slow_version(spark, monkeypatch):
    """Whole documents, over many chunks and pieces."""
    monkeypatch.setattr(language_model, "CHUNK", 150)
    monkeypatch.setattr(language_model, "PIECE", 40)
    rng = random.Random(9)
    texts = {i: " ".join(rng.choice(["Ab", "abc", "c d", "é", "zoo", ""]) for _ in range(rng.randrange(12))) for i in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    lowered = {i: brute.lower(t).encode() for i, t in texts.items()}
    slow = slow_ppm([t for i, t in lowered.items() if brute.remainder(i, 5) != 1], 3)
    rows = language_model.score(df, order=3).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        s = [256] * 3 + list(lowered[r["doc_id"]]) + [256]
        want = sum(math.log10(slow(s[i - 3 : i][::1], s[i])) for i in range(3, len(s)))
        assert abs(r["score"] - want) < 1e-8 * max(1, abs(want))


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if brute.remainder(i, 5) == 1)
    rows = language_model.score(spark.createDataFrame([(held, "ab")], "doc_id long, text string")).collect()
    assert [(r["n_known"], r["train_tokens"], round(r["score"], 9)) for r in rows] == [(0, 0, round(-3 * math.log10(257), 9))]


def test_the_model_runs_where_the_package_is_not(tmp_path):
    """Driver and workers in another folder, the package on the driver's path alone."""
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import os, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {str(tmp_path / "scratch")!r}).getOrCreate())
sys.path.insert(0, {repo!r})
from tallyloom.llm import chat_format, conversation_repair, language_model, periodic_runs
df = spark.createDataFrame([(i, "ab cd " * i) for i in range(9)], "doc_id long, text string")
assert language_model.score(df).count() == 9
assert periodic_runs.report(df).count() == 9
turns = spark.createDataFrame([(1, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
assert conversation_repair.report(conversation_repair.repair(turns)).count() == 1
assert chat_format.report(chat_format.formatted(turns.selectExpr("*", "0 as place"))).count() == 1
print("fine")
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_language_model_of_the_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counts = Counter()
    for i, t in docs.items():
        if brute.remainder(i, 5) != 1:
            counts.update([*brute.WORD.findall(brute.lower(t)), " "])
    total, types = sum(counts.values()), len(counts)
    rows = QUERIES["op6_ppm"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        tokens = [*brute.WORD.findall(brute.lower(docs[r["doc_id"]])), " "]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in tokens)
        assert r["held_out"] == (brute.remainder(r["doc_id"], 5) == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)


def test_language_model_beats_its_base(spark):
    held = QUERIES["op6_ppm"](spark, "/root/testdata/sf0.1").where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


def test_language_model_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK", 100)
    monkeypatch.setattr(language_model, "PIECE", 50)
    rows = [(1, None), (2, ""), (2, ""), (3, "Ab ab AB"), (None, "ab"), (4, "long words " * 5000), ((1 << 60) + 1, "é" * 300)]
    df = spark.createDataFrame([(i, t, True, 1.0) for i, t in rows], "doc_id long, text string, held_out boolean, score double")
    got = language_model.score(df, order=2).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert set(by) == {1, 2, 3, None, 4, (1 << 60) + 1}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == 1 and by[3]["n_tokens"] == 4 and by[4]["n_tokens"] == 10001
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert language_model.score(df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li><li>Two</li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy these many things now.</div><article><h1>Head &amp; tail</h1><p><b>First
   line.<br>Second &lt;b&gt;<p>Short.</p><form><p>Your mail</p></form><p>Caf&eacute; &#8364; &#x41;</p>
<section id="comments"><p>I liked this article very much and said so.</p></section><ul><li>Item</li></ul></article>
<aside>Beside the point</aside><div class="cookie-notice">We use cookies on this page.</div><footer>&copy; me</footer>"""


def test_page():
    tree = html_extraction.train()
    want = "Head & tail\n\nFirst line. Second <b>\n\nShort.\n\nCafé € A\n\nItem"
    assert html_extraction.main_text(PAGE, tree) == want
    x, y = html_extraction.labelled_blocks()
    right = [html_extraction.keeps(tree, list(r)) == v for r, v in zip(x, y, strict=True)]
    assert sum(right) >= 0.98 * len(right)


#: Unmarked pages that the tree hasn't seen, in the notation of the labelled ones.
HELD_OUT = (
    "2/2 1/1 *h7 *41 *36/2 *8 *55 *49 3/3 4/4 6",
    "3 1/1 1/1 *h9 5 *66 *13 *72 *5 *58 2/2 3 23",
    "1/1 2/2 18 3/3 *h6 *24 *29 *33 *7 *26 1/1 5/5 4/4 3",
    "7/7 8/8 6/6 *h8 3 *47 *53/4 *39 6/6 7/7 9/9",
    "2 2/2 *h5 *35 *h4 *42 *17 *h3 *38 *6 *44 1/1 2 4",
    "1/1 1/1 2/2 *75 *88 *64/2 *92 *11 *70 3/3 2/2 8",
    "h6/6 13/7 h5/5 11/8 *h7 *48 *51 *4 *57 2/2 h5/5 12/7",
    "4 3/3 *h8 2 *21 *27 *18 *23 *9 *25 2 3/3 16/2",
)


def test_tree_reads_neighbours():
    """Facts 0, 1, 4 and 5 belong to the blocks around; held-out blocks and words are mostly right."""
    tree = html_extraction.train()

    def used(t):
        return set() if len(t) == 1 else {t[0]} | used(t[2]) | used(t[3])

    assert used(tree) & {0, 1, 4, 5}
    blocks = words = right_blocks = right_words = 0
    for page in HELD_OUT:
        own, labels = html_extraction.sketched(page)
        for b, f, label in zip(own, html_blocks.facts(own), labels, strict=True):
            same = html_extraction.keeps(tree, f) == label
            blocks, words = blocks + 1, words + b.words
            right_blocks, right_words = right_blocks + same, right_words + same * b.words
    assert right_blocks >= 0.93 * blocks and right_words >= 0.97 * words
    # The same short paragraph, between long ones and among short links.
    text = lambda n: " ".join(["word"] * n)
    long = f"<p>{text(50)}</p>"
    inside = html_extraction.main_text(f"{long}<p>short one here</p>{long}", tree)
    among = html_extraction.main_text(f"{long}{long}<p><a href=1>a b</a></p><p>short one here</p><p><a href=2>c d</a></p>", tree)
    assert "short one here" in inside and "short one here" not in among


LONG = "<p>" + " ".join(["word"] * 40) + ".</p>"


@pytest.mark.parametrize(
    "page, words",
    [
        (f'<body class="has-sidebar"><h1>Title of it all</h1>{LONG * 3}</body>', 124),
        (f'<body class="sidebar">{LONG * 3}</body>', 120),
        (f'<p class="x"">Hello {"word " * 30}</p>{LONG * 3}', 151),
        (f"<p title=it's>Some {'text ' * 30}</p>{LONG * 2}", 111),
        (f"<p a='x>y' b = \"p>q\">Some {'text ' * 30}</p>{LONG * 2}", 111),
        (f'<div id="page" class="sidebar-left">{LONG * 4}</div><p><a href=1>x</a></p>', 160),
        (f"<form action=/>{LONG * 3}</form>", 120),
        (f'<div class="with-ads no-sidebar">{LONG * 2}</div><div class="sidebar">{LONG}</div>{LONG * 2}', 160),
        (f'{LONG * 2}<div class="comments">{LONG * 3}</div>', 80),
        (f"{LONG * 2}<p>last <a href=' never closed {LONG}", 80),
    ],
)
def test_kept_words_of_broken_and_unmarked_pages(page, words):
    assert len(html_extraction.main_text(page, html_extraction.train()).split()) == words


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- never closed", "<script>x", "&am", "<p>" * 3000, "<a href='x", "</p></div>"])
def test_broken_pages(page):
    assert "<p" not in html_extraction.main_text(page, html_extraction.train())


def test_plain_words_are_one_block():
    assert [b.text for b in blocks_of("just some   words")] == ["just some words"]


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").toPandas()
    rows = {r["page_id"]: r for r in QUERIES["op5_main_text"](spark, SF_DIR).collect()}
    assert sorted(rows) == sorted(pages["page_id"])
    for page_id, url, page in pages[["page_id", "url", "html"]].itertuples(index=False):
        want = brute.article(page)
        assert (rows[page_id]["url"], rows[page_id]["text"], rows[page_id]["n_chars"]) == (url, want, len(want))


def test_odd_page_rows(spark):
    df = spark.createDataFrame([(1, None, None, 3), (1, "u", "", 4), (None, "v", PAGE, 5)], "page_id long, url string, html string, n_chars int")
    rows = html_extraction.extract(df).collect()
    assert sorted((r["text"] or "", r["n_chars"]) for r in rows)[:2] == [("", 0), ("", 0)]
    assert html_extraction.extract(df.limit(0)).count() == 0
