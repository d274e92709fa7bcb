"""The ten operators against brute force, on the given tables and on a table of odd rows."""

import hashlib
import importlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import brute
from lacuna.llm import chat, hilbert, html_text, mixing, packing, quality, simhash, substring, topk, urls
from lacuna.llm.queries import QUERIES, tokenizer_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, h string, __size long, spans string"


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice([f"w{i}" for i in range(vocabulary)]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, copies, near copies, ties, repeated rows,
    and extra columns named like working columns."""
    rng = random.Random(5)
    base, long_text = prose(rng, 300, 3000), prose(rng, 6000, 900)
    passage = prose(rng, 60, 5000)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "b"), (None, base, "en", None), (4, base, "en", "b"),
            (5, base + " tail", None, "b"), (6, base.replace("w1", "W1"), "de", None), (7, long_text, "de", "a"),
            (8, "x y", "fr", "c"), (9, passage + " " + prose(rng, 50), "fr", "c"), (10, prose(rng, 70) + "\n" + passage, "fr", "Z"),
            (10, "same id other text é ß \u2003 end " * 3, "fr", "Z"), (11, "a b c d e f g h i j\na b c d e f g h i j", "en", "a"),
            (12, "# * $ % & | < > word", "en", "a"), (13, "spam " * 80, "en", "a")]
    rows += [(20, base, "en", "a")] * 3 + [(100 + i, long_text, "en", "a") for i in range(12)]
    rows += [(200 + i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "de", None]), rng.choice("abc")) for i in range(60)]
    return spark.createDataFrame([(*r, 0, "x", 1, "y") for r in rows], DOC)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOC)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def key(rows):
    return sorted(rows, key=repr)


def docs_of(df):
    return pairs(df, "doc_id", "text")


# --- 1

def test_simhash_equals_brute_force(odd):
    want = brute.near_duplicates(docs_of(odd))
    assert key(pairs(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id")) == key(want)


@pytest.mark.parametrize("scheme", [(5, 1), (6, 2), (7, 3)])
def test_any_cut_finds_the_same_links(spark, scheme, monkeypatch):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    codes = set(seeds.tolist())
    for s in seeds.tolist():  # balls and chains around each seed
        for _ in range(20):
            for b in rng.integers(0, 64, 3).tolist():
                s ^= 1 << b
            codes.add(s)
    codes = np.array(sorted(codes), np.uint64)
    i, j = np.nonzero(np.triu(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4, 1))
    want = simhash.star(len(codes), i, j)
    fps = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "fp long")
    monkeypatch.setattr(simhash, "NODE", 16)  # many cut runs
    got = {r[0]: r[1] for r in simhash.components(simhash.links(fps, 4, scheme)).collect()}
    groups = defaultdict(set)
    for c, w in zip(codes.view(np.int64).tolist(), want.tolist()):
        groups[w].add(c)
    for g in groups.values():
        assert len({got.get(c, c) for c in g}) == 1
    assert len({got.get(c, c) for c in codes.view(np.int64).tolist()}) == len(groups)


def test_tree_search_equals_all_pairs():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 12, 700, dtype=np.uint64) << np.uint64(20)
    i, j = simhash.linked_pairs(a, a, 2, True)
    d = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*np.nonzero(np.triu(d, 1))))


def test_one_row_of_each_component_stays(odd, none):
    want = {(d, f) for d, f, c in brute.near_duplicates(docs_of(odd)) if d == c}
    got = [(d, f"{brute.simhash(t):016x}") for d, t in docs_of(simhash.one_per_group(odd))]
    assert len(got) == len(set(got)) and set(got) == want
    assert simhash.one_per_group(odd).columns == odd.columns
    assert simhash.one_per_group(none).count() == simhash.near_duplicates(none).count() == 0


# --- 2

def test_rules_and_parts(spark):
    given = ["http://Example.ORG/es/1?x", "https://a.b.example.org/en/17#z", "x://q.com/fr/", "x://q.com/de/9", "x://q.com", "x://com/de/",
             "nothing", None, "", "http://", "http://a.org:80/es/", "http://badexample.org/es/1", "http://h.net?x=://y/z", "a://b/c://d/e"]
    df = spark.createDataFrame([(i, u, None, "e") for i, u in enumerate(given)], "page_id long, url string, bad int, node string")
    got = {r.page_id: r for r in urls.judge_urls(df).collect()}
    assert len(got) == len(given)
    for i, u in enumerate(given):
        host, path = brute.url_parts(u)
        r, v = brute.rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, r, v or "allow")
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_rules_are_those_of_the_contract(spark):
    want = {"http://example.org/en/12": ("example.org/en/1", "block"), "http://a.example.org/es/": ("example.org/es/", "block"),
            "http://example.org/en/2": ("org/", "allow"), "http://x.com/fr/1": ("com/fr/", "allow"), "http://x.com/de/1": ("com/de/", "block")}
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(want)], "page_id long, url string, bad int")
    assert [(r.rule, r.verdict) for r in urls.judge_urls(df).orderBy("page_id").collect()] == list(want.values())


def test_templates_follow_labels(spark):
    rows = [(f"http://h.net/{kind}/{i}", int(kind == "junk")) for kind in ("junk", "good", "fine") for i in range(30)]
    rows += [(f"http://h.net/{kind}/9{i}", None) for kind in ("junk", "good") for i in range(5)]
    df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = urls.judge_urls(df).collect()
    assert all((r.verdict == "block") == ("/junk/" in r.path) for r in got)
    assert {r.template for r in got} == {"/junk/*/", "/fine|good/*/"}  # equal branches are one


def test_names_of_branches_are_not_keys(spark):
    def verdicts(rows):
        df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
        return {(r.path.split("/")[1], r.template, r.verdict) for r in urls.judge_urls(df).collect()}

    rows = [(f"http://h.net/{kind}/{i}", int(kind == "a|b")) for kind in ("a", "b", "a|b") for i in range(60)]
    assert verdicts(rows) == {("a", "/a|b/*/", "allow"), ("b", "/a|b/*/", "allow"), ("a|b", r"/a\|b/*/", "block")}
    rows = [(f"http://h.net/*/{i}", 1) for i in range(60)] + [(f"http://h.net/{i}/{i}", 0) for i in range(60)]
    got = verdicts(rows)  # a segment named like the wildcard
    assert all((v == "block") == (s == "*") for s, _, v in got) and {t for s, t, _ in got if s == "*"} == {r"/\*/*/"}


def test_unlabelled_and_thin_siblings_tie_no_branches(spark):
    def verdicts(rows):
        df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
        return {r.path.split("/")[1]: r.verdict for r in urls.judge_urls(df).collect()}

    rows = [(f"http://h.net/{kind}/{i}", int(kind == "junk")) for kind in ("junk", "good") for i in range(60)]
    rows += [("http://h.net/", None)] * 3 + [(f"http://h.net/new/{i}", None) for i in range(40)]
    got = verdicts(rows)
    assert got["junk"] == "block" and got["good"] == "allow"
    rows += [(f"http://h.net/mix{b}/{i}", int(i < b)) for b in range(11) for i in range(10)]
    got = verdicts(rows)  # neighbours in a chain of thin sections are never apart, its ends are
    assert got["junk"] == "block" and got["good"] == "allow"


def test_thin_and_deep_sections_have_their_own_verdicts(spark):
    rows = [(f"http://wide.net/s{chr(97 + k)}/{i}", int(k == 7)) for k in range(25) for i in range(40)]
    rows += [(f"http://deep.net/a/b/c/{kind}/d/{i}", int(kind == "bad")) for kind in ("good", "bad") for i in range(30)]
    rows += [("http://lone.net/" + "x/" * 300, None)]
    df = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    got = urls.judge_urls(df).collect()
    assert len(got) == len(rows)
    assert all((r.verdict == "block") == ("/sh/" in r.path or "/bad/" in r.path) for r in got)


# --- 3

def test_mixing_meets_targets(odd, none):
    rows = pairs(mixing.mix(odd), "doc_id", "size", "source_size", "target", "taken")
    sizes = defaultdict(int)
    for s, t in pairs(odd, "source", "text"):
        sizes[s] += len(brute.WORD.findall(t or ""))
    target = brute.mix_targets(sizes)
    assert {r[3] for r in rows} == set(target.values())
    taken = defaultdict(int)
    for _, size, _, t, k in rows:
        assert 0 <= k <= 2 * size
        taken[t] += k
    assert all(abs(t - k) <= 12 for t, k in taken.items())  # a row of a tie loses under one word
    assert key(rows) == key(pairs(mixing.mix(odd.repartition(7)), "doc_id", "size", "source_size", "target", "taken"))
    assert mixing.mix(none).count() == mixing.mixed_documents(none).count() == 0


def test_mixed_documents_are_whole(odd):
    """The row at the threshold comes whole or not at all, whichever is nearer."""
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    want = []
    taken = defaultdict(list)
    for d, size, k in pairs(mixing.mix(odd), "doc_id", "size", "taken"):
        taken[d, size].append(k)
    for d, t in docs_of(odd):
        size = len(brute.WORD.findall(t or ""))
        k = taken[d, size].pop()
        want += [(d, t)] * (k // size + (2 * (k % size) >= size) if size else 0)
    assert key(docs_of(out)) == key(want)


# --- 4

def test_packing_holds_every_token(odd, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    want, total = [], 0
    for d, t in docs_of(odd):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        want += [(d, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cuts(len(ids), 512))]
    rows = pairs(packing.pack(odd, tokenizer_path(), 512, group_rows=4), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    assert key(r[:5] for r in rows) == key(want)
    held = defaultdict(list)
    for r in rows:
        held[r[5]].append((r[6], r[3]))
    for places in held.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 512
    assert len(held) <= 1.02 * -(-total // 512) + 1
    assert packing.pack(none, tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_any_histogram(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 2048): rng.randint(1, 400) for _ in range(rng.choice([1, 3, 40, 900]))}
    plan = packing.pack_plan(counts, 2048)
    got = defaultdict(int)
    for lengths, n in plan:
        assert sum(lengths) <= 2048 and n > 0
        for x in lengths:
            got[x] += n
    assert got == counts


def test_nonnegative_fit_is_optimal():
    rng = np.random.default_rng(3)
    a, y = rng.random((12, 30)), rng.random(12)
    x = packing.nonnegative_fit(a, y)
    gradient = a.T @ (a @ x - y)
    assert x.min() >= 0 and gradient.min() > -1e-7 and abs(gradient[x > 0]).max() < 1e-7


def test_fast_encoder_gives_the_same_ids():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    assert list(packing.encoder(tokenizer_path())("a <|endoftext|> b")) == tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    encode, rng = packing.encoder(tokenizer_path()), random.Random(9)
    alphabet = "ab Z'st1 \n\t\r\u00a0é漢字🙂<|endoftext|>\x00\u2028.,-#"
    for _ in range(400):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        t += "<|endoftext|>" * rng.randint(0, 2) + t[:5]
        assert list(encode(t)) == tok.encode(t, add_special_tokens=False).ids


# --- 5

def vectors(spark, rows):
    return spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<float>, label int, lane string")


def top_by_hand(rows, k=20):
    ok = {(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    ok = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in ok]
    out = []
    for i, v in ok:
        if i % 20 == 0:
            hits = sorted((-max(1 - 2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in ok if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(hits, 1)]
    return out


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    for name, n in (("QUERY_ROWS", 2), ("LANE_BLOCKS", 2), ("GROUP_BLOCKS", 2), ("MERGED_LANES", 3)):
        monkeypatch.setattr(topk, name, n)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.01, -0.2, 0.3]) for _ in range(rng.choice([3, 6]))], i) for i in range(90)]
    rows += [(None, [1.0], 0), (200, None, 0), (201, [None, 1.0], 0), (202, [float("nan")], 0), (203, [float("inf")], 0), (220, [], 0)]
    rows += [(40, rows[40][1], 7), (300, [1e30, -1e30], 0)]
    got = [tuple(r) for r in topk.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()]
    assert sorted(got) == sorted(top_by_hand(rows))
    assert topk.search(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0


# --- 6

def test_quality_counts_equal_brute_force(odd, none):
    got = pairs(quality.judge(odd), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert key(got) == key((d, *brute.quality(t)) for d, t in docs_of(odd))
    assert quality.judge(none).count() == quality.kept_documents(none).count() == 0
    kept = quality.kept_documents(odd)
    assert kept.columns == odd.columns and kept.count() == quality.judge(odd).filter("kept").count()


def test_lines_above_the_limit_deplete_documents(spark):
    rng = random.Random(6)
    menu = "Home 1 | About Us | Contact\nTerms and Privacy 2024\nall rights reserved by us\n"
    rows = [(i, menu.replace("1", str(i)) + prose(rng, 100), None, "h") for i in range(40)]
    rows += [(100, menu + "only three words", None, "h"), (101, menu + "only three words", None, "g"), (102, prose(rng, 200), None, "h")]
    rows += [(200 + i, "one copied text of well over ten words in one single line here\n" + "x " * 5, None, "h") for i in range(50)]
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[100]
    assert all(v for d, v in got.items() if d != 100)


def test_long_lines_above_the_limit_count(spark):
    rng = random.Random(12)
    notice = "  Licensed under\tthe terms " + prose(rng, 60) + " 2024 \r\n"
    rows = [(i, notice.replace("2024", str(i)).replace("\t", "  ") + prose(rng, 200), None, "h") for i in range(30)]
    rows += [(100, notice, None, "h"), (101, notice + "only three words", None, "h"), (102, notice, None, "g")]
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[100] and not got[101]
    assert all(v for d, v in got.items() if d not in (100, 101))


@pytest.mark.parametrize("words", [20, 21])
def test_one_rule_for_lines_of_any_length(spark, words):
    rest = " ".join("abcdefghijklmnopqrstuvwxyz"[:words - 2])
    own = ["".join("abcdefghij"[int(c)] for c in str(i)) for i in range(60)]
    rows = [(i, f"item{i} {i} {rest}\nonly mine {own[i]}", None, "h") for i in range(60)]  # differ in a word
    rows += [(100 + i, f"item {i} {rest}\nonly mine {own[i]}", None, "g") for i in range(60)]  # differ in a number
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(v == (d < 100) for d, v in got.items())


def test_boilerplate_lines_leave_the_stage(spark, odd, none):
    rng = random.Random(13)
    line = "Home 7 | About us"
    body = [prose(rng, 60) + "\n\n " + prose(rng, 30) for _ in range(30)]
    rows = [(i, "\r\n" + line.replace("7", str(i)) + "\n" + b, "en", "h", 5) for i, b in enumerate(body)]
    rows += [(50, line + "\n" + body[0], "en", "g", 5), (51, "a\n" + body[1], None, None, 5), (52, line + " only", "en", "h", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(importlib.import_module("corpus_pipeline").STAGES)["quality_rules"]
    want = [(i, "\r\n" + b, len(b) + 2) for i, b in enumerate(body)] + [(r[0], r[1], 5) for r in rows[30:32]]
    assert key(pairs(stage(spark, df, SF), "doc_id", "text", "n_chars")) == key(want)
    assert quality.cleaned_documents(odd).columns == odd.columns and quality.cleaned_documents(none).count() == 0
    assert key(docs_of(quality.cleaned_documents(odd))) == key(docs_of(quality.kept_documents(odd)))


# --- 7

HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>'</script></head><body>"


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(html_text.labelled_sample(spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet")))


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), (HEAD, ""),
    (HEAD + "<nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>A &amp; B</h1><p>One  two\n three four five six.</p><p><b>Bold</b>er text of "
     "some more words here.<br>Next.<p>Unclosed paragraph with several words.</article><footer>&copy; us</footer>",
     "A & B\nOne two three four five six.\nBolder text of some more words here. Next.\nUnclosed paragraph with several words."),
    (HEAD + "<HEADER><P>Site of many words and a slogan</P></HEADER><main><p>The main text stands in this paragraph of words.</p>"
     "<aside><p>Other stories that you may like to read today.</p></aside><form><p>Sign up for our letter now, please.</p><input></form>"
     "<div class='user-comments'><p>I liked this text a lot, thank you very much.</p></div></main>",
     "The main text stands in this paragraph of words."),
    (HEAD + "<div id=cookieNotice><p>We use cookies to make this site better for you.</p></div><div class=post><p>Some words of a real "
     "paragraph, long enough to be read.</p><div class=advert>Buy it now for less than ever before!</div></div><!-- <p>x</p> -->",
     "Some words of a real paragraph, long enough to be read."),
])
def test_main_text(model, page, want):
    assert model.text(page or "") == want


UNSEEN = "The first paragraph of a text has words enough to stand alone.\nThe second one has as many words as that, or some more."


@pytest.mark.parametrize("before, after", [
    ("<div class='layout has-sidebar'><article>", "</article></div>"),
    ("<form id=aspnetForm method=post><div id=wrap><article>", "</article></div><input type=hidden></form>"),
    ("<div class=row>", "</div>"),
    ("<article><header>", "</article>"),
    ("<main class='search'>", "</main>"),
    ("<div class='entry tags'>", "</div>"),
    ("<div id=post class='menu-item'>", "</div>"),
    ("<div class=no-comments><section class='story with-footer'>", "</section></div>"),
])
def test_misleading_names_of_unseen_templates(model, before, after):
    h1 = "A heading of the text"
    ps = [f"<p>{x}</p>" for x in UNSEEN.split("\n")]
    close = "</header>" if before.endswith("<header>") else ""
    body = f"{before}<h1>{h1}</h1>{close}{''.join(ps)}{after}"
    noise = ("<nav class=top><ul><li><a href=/>Home</a><li><a href=/b>More of it</a></ul></nav>",
             "<section id=comments><article class=comment><p>I liked this text a lot, thank you very much.</p></article></section>"
             "<div class='post-footer'><p>All rights are reserved by the owners of it.</p></div><aside><p>Other stories that you may like to read.</p></aside>")
    page = noise[0] + body + noise[1]
    assert model.text(HEAD + page) == model.text(f"{HEAD}<form id=aspnetForm>{page}</form>") == h1 + "\n" + UNSEEN


def test_learning_alone_finds_the_articles(spark, monkeypatch):
    """Half of the pages train, without any invented observation; the other half is held out."""
    import html as h
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    monkeypatch.setattr(html_text, "PRIOR", [])
    got = html_text.train(html_text.labelled_sample(pages.filter("page_id % 2 = 0"), spark.read.parquet(f"{SF}/documents.parquet")))
    for r in pages.filter("page_id % 2 = 1").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(h.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got.text(r.html) == "\n".join(b for b in blocks if b)


def test_marginals_equal_enumeration(model):
    from itertools import product
    page = html_text.Page(HEAD + "<nav>a</nav><article><p>some words here</p><div class=ad>b</div></article>")
    own, n = [model.node(v) for v in page.features()], len(page.parent)
    own[0] = tuple(model.root)
    on, total = [0.0] * n, 0.0
    for s in product((0, 1), repeat=n):
        p = np.exp(sum(own[i][s[i]] for i in range(n)) + sum(model.edge[s[page.parent[i]]][s[i]] for i in range(1, n)))
        total += p
        for i in range(n):
            on[i] += p * s[i]
    assert np.allclose(model.marginals(page), [x / total for x in on])


def test_html_query_on_held_out_pages(spark):
    """Trained on some pages, every article of the others is found whole."""
    import html as h
    import re
    rows = QUERIES["op7_html"](spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_pages(spark, model):
    df = spark.createDataFrame([(None, None, None, "x"), (1, "u", "<p>" * 3000 + "deep", "x"), (1, "u", "a<b", "x"), (2, "u", "<div " * 500, "x")],
                               "page_id long, url string, html string, text string")
    assert html_text.extract(df, model).count() == 4
    assert html_text.extract(df.limit(0), model).count() == 0


# --- 8

def test_substring_equals_brute_force(odd, none):
    docs = docs_of(odd)
    want = [(d, *r) for (d, _), r in zip(docs, brute.repeats([t for _, t in docs]))]
    assert key(pairs(substring.digests(odd), "doc_id", "n_words", "n_removed", "kept_sha256")) == key(want)
    assert substring.digests(none).count() == substring.without_repeats(none).count() == 0
    out = substring.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == len(docs)
    sha = key((d, hashlib.sha256(" ".join(brute.WORD.findall(t or "")).encode()).hexdigest()) for d, t in docs_of(out))
    assert sha == key((w[0], w[3]) for w in want)


def test_places_beyond_their_bits(monkeypatch):
    """Minimizers of a text with more grams than a place can number are those of its parts."""
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [(" ".join(f"w{i}" for i in rng.integers(0, 900, n)) + " " + passage).encode() for n in (40, 5000, 9000)]
    monkeypatch.setattr(substring, "_PLACE", np.uint64(255))
    found = []
    for t in texts:
        chunk = substring.Chunk([t])
        d, start, count, mh, sh, a = substring.segments(chunk)
        inside = start + count + 34 > len(chunk.hash) - 60 + 34
        found.append(set(mh[inside].tolist()))
        at = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
        assert (at == np.arange(len(chunk.hash) - 34)).all()  # every window is in one segment
    assert len(found[0] & found[1] & found[2]) > 0
    rng = np.random.default_rng(5)
    grams = substring.mixed(rng.integers(0, 2 ** 60, 3000).astype(np.uint64), 1)
    got = substring.minimizer_places(grams, 23)
    low = grams & ~np.uint64(255)
    assert (got == [i + int(np.argmin(low[i:i + 23])) for i in range(len(grams) - 22)]).all()


@pytest.mark.parametrize("hot", [1, 3, 4096])
def test_substring_with_hot_minimizers(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    rng = random.Random(hot)
    passage, line = prose(rng, 50, 900).split(), prose(rng, 20, 900).split()
    texts = ["p q r " * 40, "z " * 100, "z " * 36]
    for i in range(60):
        t = prose(rng, 80, 300).split()
        cut = rng.randint(0, 50)
        t[cut:cut] = passage[rng.randint(0, 10):rng.randint(30, 50)] if i % 2 else line
        if i % 5 == 0:
            t[rng.randint(0, len(t) - 1)] = "edit"
        texts += [" ".join(t)] * rng.choice([1, 1, 2])
    got = pairs(substring.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(got) == [(i, *r) for i, r in enumerate(brute.repeats(texts))]


def test_fm_index_counts():
    rng = np.random.default_rng(7)
    text = np.concatenate(([0], rng.integers(1, 4, 300), [0], rng.integers(1, 4, 200), [0]))
    index = substring.FmIndex(text, 3)
    s = "".join(map(str, text))
    ends = np.array([e for e in range(40, 300)])
    got = index.matching(text, ends, 35)
    for e, n in zip(ends.tolist(), got.tolist()):
        def often(m):
            p = s[e - m:e]
            return sum(s.startswith(p, i) for i in range(len(s))) > 1
        assert often(n) and (n == 35 or not often(n + 1))


# --- 9

def test_shards(odd, none, spark):
    rows = pairs(hilbert.shard(odd, 8, group_rows=2), "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert key(r[:3] for r in rows) == key((d, len((t or "").encode()) + 1, brute.crc(t)) for d, t in docs_of(odd))
    held = defaultdict(list)
    for r in rows:
        assert r[3] == "rows" and r[6] is None
        held[r[4]].append(r[5])
    assert set(held) == set(range(8)) and max(map(len, held.values())) - min(map(len, held.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    assert hilbert.shard(none).count() == 0
    assert sorted(r[0] for r in pairs(hilbert.shard(odd.limit(3)), "shard")) == [0, 2, 5]


def test_equal_texts_lie_together_and_files_tell_their_bounds(spark, odd, tmp_path):
    rows = pairs(hilbert.ranked(odd, 4, 2), "crc", "rank")
    assert sorted(r for _, r in rows) == list(range(len(rows)))
    places = defaultdict(list)
    for c, r in rows:
        places[c].append(r)
    assert all(max(p) - min(p) + 1 == len(p) for p in places.values()) and max(map(len, places.values())) >= 12
    bounds = {b.shard: b for b in hilbert.write(odd, str(tmp_path / "s"), 4, 2).collect()}
    back = spark.read.parquet(str(tmp_path / "s" / "data"))
    assert key(tuple(r) for r in back.drop("__shard").collect()) == key(tuple(r) for r in odd.collect())
    for r in back.collect():
        b = bounds[r["__shard"]]
        size, lines = len((r.text or "").encode()) + 1, (r.text or "").count("\n") + 1
        assert b.size_min <= size <= b.size_max and b.lines_min <= lines <= b.lines_max
        assert r.lang is None or b.lang_min <= r.lang <= b.lang_max
    assert sum(b.rows for b in bounds.values()) == len(rows)


def test_many_languages_share_steps_with_neighbours(spark):
    df = spark.createDataFrame([(i, "t", None if i == 40 else f"l{i:02d}") for i in range(41)], "doc_id long, text string, lang string")
    steps, n = hilbert.language_steps(df)
    got = {r["__lang"]: r.step for r in steps.collect()}
    assert n == 41 and got == {None if i == 40 else f"l{i:02d}": i * 16 // 41 for i in range(41)}


def test_curve_visits_neighbours():
    cells = sorted(hilbert.curve_cells(3, 3), key=lambda c: c[1])
    assert [c[1] for c in cells] == list(range(512))
    points = [((c >> 6), (c >> 3) & 7, c & 7) for c, _ in cells]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(points, points[1:]))


def test_shards_are_compact(spark):
    """Each shard holds few of the languages or few of the lengths: files can be skipped."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = hilbert.shard(d).join(d.select("doc_id", "lang"), "doc_id").groupBy("shard").agg(F.countDistinct("lang").alias("n")).collect()
    assert sum(r.n for r in got) < 4 * 8


# --- 10

def test_events_fold(spark):
    log = [(1, 0, 0, "message", "user", "hi"), (1, 1, 1, "start", "assistant", ""), (1, 1, 2, "delta", None, "Hel"), (1, 1, 3, "delta", None, "lo"),
           (1, 0, 4, "edit", None, "hey"), (1, 1, 5, "regenerate", None, "A"), (1, 1, 6, "delta", None, "gain"), (1, 2, 7, "message", "user", "bye"),
           (1, 2, 8, "delete", None, None), (2, 0, 0, "delta", "user", "lost start"), (2, 1, 1, "unknown", None, None)]
    df = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.reconstruct(df).collect()}
    assert got[1] == [("user", "hey"), ("assistant", "Again")]
    assert got[2][0] == ("user", "lost start")


def test_chats_round_trip(spark):
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<\\|im_end|>\n", "[INST]", "[\\\\/INST]", "<<SYS>>", "<", "\\", "</s>", "é", "", "<s>", "\\n"]
    rng = random.Random(8)

    def some():
        return "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))

    rows = [(c, t, rng.choice(["user", "assistant", "assistant", some()]), some(), "x") for c in range(40) for t in range(rng.randint(1, 5))]
    rows += [(None, 1, None, None, "x"), (50, None, "user", "late", "x"), (50, 0, "user", "a", "x"), (50, 0, "user", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    chats = chat.render(chat.reconstruct(chat.row_events(df)))
    got = {r.conv_id: r for r in chat.digests(chats).collect()}
    shown = {r.conv_id: r.formatted for r in chats.collect()}
    by = defaultdict(list)
    for c, t, r, x, _ in rows:
        by[c].append((t is None, t or 0, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns) and g.formatted_chars == len(shown[c])
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert shown[c].count("<|im_end|>") == len(turns) and "[INST]" not in shown[c]
    empty = chat.reconstruct(chat.row_events(df.limit(0)))
    assert chat.digests(chat.render(empty)).count() == 0


# --- SQL and the pipeline

@pytest.mark.parametrize("name", ["op2_url_filters", "op3_mixing", "op5_topk", "op6_quality", "op8_substring", "op9_sharding", "op10_chat", "op11_warc",
                                  "op12_prefix_trie", "op13_hard_negatives"])
def test_sql_oracles(spark, name):
    import duckdb
    from lacuna.llm.sql import ORACLES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert set(names) == set(df.columns)
    assert key(tuple(r) for r in df.select(*names).collect()) == key(cur.fetchall())


def test_pipeline_equals_brute_force(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = out[name] = spark.read.parquet(str(tmp_path / name))
        if name != "pack_sequences":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = pairs(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")
    clean = [(d, t) for d, t in first if not brute.quality(t)[5]]
    assert set(docs_of(out["quality_rules"])) <= set(clean)
    assert out["quality_rules"].count() > 0.95 * len(clean)
    fed = docs_of(out["quality_rules"])
    assert sorted(d for d, _ in docs_of(out["near_dedup"])) == sorted({c for _, _, c in brute.near_duplicates(fed)})
    fed = sorted(docs_of(out["near_dedup"]))
    want = {d: r[2] for (d, _), r in zip(fed, brute.repeats([t for _, t in fed]))}
    got = {d: hashlib.sha256(" ".join(brute.WORD.findall(t)).encode()).hexdigest() for d, t in docs_of(out["substring_dedup"])}
    assert got == want
    copies = {d: k // n + (2 * (k % n) >= n) for d, n, k in pairs(mixing.mix(out["substring_dedup"]), "doc_id", "size", "taken") if n}
    text = dict(docs_of(out["substring_dedup"]))
    assert key(docs_of(out["mix_sources"])) == key((d, text[d]) for d, n in copies.items() for _ in range(n))
    assert key(pairs(pipeline.run(spark, SF), "doc_id", "piece", "length")) == key(pairs(out["pack_sequences"], "doc_id", "piece", "length"))
    seqs = pairs(out["pack_sequences"].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k")), "n")
    assert max(s[0] for s in seqs) <= 2048
