"""Archives, prefix tries and hard negatives against brute force and planted damage."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from lacuna.llm import common, negatives, trie, warc
from pyspark.sql import functions as F

# --- 11

PAGE = "page_id long, url string, html string, uid string, of int, sha string"
FAKE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nPage-ID: 77\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


@pytest.fixture(scope="module")
def pages(spark):
    """Nulls, empty, long and repeated payloads, payloads that look like records or framing."""
    rng = random.Random(3)
    long_html = "".join(chr(rng.choice([9, 10, 13, 65, 233, 0x4E2D, 0x1F600])) for _ in range(20_000))
    rows = [(1, "http://a/ b\r\nX-Evil: 1", "x" + FAKE * 3), (2, None, None), (3, "u", ""), (4, "u", long_html), (5, "u", long_html), (None, "u", long_html),
            (6, "<>", "WARC/1.1\r\n\r\n"), (7, "u", "\r\n\r\nWARC/"), (7, "u", "\r\n\r\nWARC/"), (8, "u", "0\r\n\r\n"), (9, "u", "\r\n\r\n" * 50),
            (10, "u", "é"), (-4, "u", "é"), (None, "u", "only null"), (None, "v", "only null"), (11, "u", "WARC/" * 2000)]
    rows += [(100 + i, f"http://h/{i}", "copy of one page " * 40) for i in range(40)]
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGE)


def want_pages(rows, min_bytes=0):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.html or "").encode()].append(r.page_id)
    out = []
    for body, ids in groups.items():
        ids.sort(key=lambda x: -math.inf if x is None else x)
        told = base64.b32encode(hashlib.sha1(body).digest()).decode()
        for n, i in enumerate(ids):
            last = n == len(ids) - 1 or len(body) < min_bytes
            out.append((i, len(body), told, "response" if last else "revisit", None if last else ids[-1], "ok"))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status").collect()), key=repr)


@pytest.mark.parametrize("segment, chunk, min_bytes", [(1 << 30, 4096, 0), (97, 7, 0), (1, 1000, 3)])
def test_archives_round_trip(pages, segment, chunk, min_bytes):
    rows = pages.filter("page_id IS NULL OR page_id NOT IN (4, 5, 11)") if segment == 1 else pages
    assert result(warc.round_trip(rows, min_bytes, segment, chunk)) == want_pages(rows.collect(), min_bytes)


def test_shared_payloads_without_broadcast(pages, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HEAVY_KEYS", 2)  # the hot payload is broadcast, the others are joined
    assert result(warc.round_trip(pages, 0, 512, 64)) == want_pages(pages.collect())


def raw_records(folder):
    """Records of gzip archives, by their Content-Length alone."""
    out = []
    for f in sorted(folder.glob("*.gz")):
        data = gzip.decompress(f.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            n = int(re.search(rb"Content-Length: (\d+)", head).group(1))
            out.append(head + b"\r\n\r\n" + rest[:n])
            assert rest[n:n + 4] == b"\r\n\r\n"
            data = rest[n + 4:]
    return out


def test_segments_are_found_wherever_they_lie(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "a"), 0, 256, 100)
    recs = raw_records(tmp_path / "a")
    assert sum(b"WARC-Type: continuation" in r.split(b"\r\n\r\n")[0] for r in recs) > 100
    random.Random(1).shuffle(recs)
    for sub, opened, ending in (("b", gzip.open, ".warc.gz"), ("c", open, ".warc")):
        (tmp_path / sub).mkdir()
        for n in range(5):
            with opened(tmp_path / sub / f"{n}{ending}", "wb") as f:
                for r in recs[n::5]:
                    f.write(r + b"\r\n\r\n")
    want = want_pages(pages.collect())
    assert result(warc.digests(warc.read(spark, str(tmp_path / "b")))) == want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)  # plain files come in several splits
    try:
        assert result(warc.digests(warc.read(spark, str(tmp_path / "c"), plain=True))) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_members_compressed_one_by_one(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "a"), 0, 256, 100)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.warc.gz").write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in raw_records(tmp_path / "a")))
    assert result(warc.digests(warc.read(spark, str(tmp_path / "b")))) == want_pages(pages.collect())


def test_damage_is_told_and_nothing_else_lost(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 200) for i in range(1, 9)], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "a"), 0, 512, 100)
    recs = raw_records(tmp_path / "a")
    of = {re.search(rb"Record-ID: (\S+)", r).group(1): int(re.search(rb"Page-ID: (\d+)", r).group(1)) for r in recs if b"Page-ID" in r}

    def page(r):
        return int(re.search(rb"Page-ID: (\d+)", r).group(1)) if b"Page-ID" in r else of[re.search(rb"Origin-ID: (\S+)", r).group(1)]

    def number(r):
        return int(re.search(rb"Segment-Number: (\d+)", r).group(1))

    out = []
    for r in recs:
        if (page(r), number(r)) in ((1, 2), (2, 1)):
            continue  # segments lost
        if page(r) == 3 and b"Total-Length" in r:
            r = re.sub(rb"Total-Length: \d+", b"Total-Length: 5", r)
        if page(r) == 4 and number(r) == 1:
            r = r.replace(b"\r\n64\r\n", b"\r\n6Z\r\n")
        if page(r) == 5:
            r = r.replace(b"page 5", b"page X")
        if page(r) == 6:
            out.append(r)  # a segment that came twice
        if page(r) == 7 and number(r) == 2:
            out.append(r[:-4] + b"????")  # two blocks of one number
        out.append(r)
    (tmp_path / "b").mkdir()
    with gzip.open(tmp_path / "b" / "x.gz", "wb") as f:
        f.write(b"\r\n\r\n".join([b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n", b"WARC/1.0\r\nno length\r\n\r\n", *out])
                + b"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort")
    got = {(r.page_id, r.status, r.payload is None) for r in warc.read(spark, str(tmp_path / "b")).collect()}
    assert got == {(1, "missing segment", True), (None, "missing segment", True), (3, "wrong total length", True), (4, "broken framing", True),
                   (5, "wrong digest", True), (6, "ok", False), (7, "two blocks of one number", True), (8, "ok", False),
                   (None, "malformed", True), (None, "truncated", True)}
    empty = df.limit(0)
    assert warc.round_trip(empty).count() == 0


def test_chunked_framing():
    body = bytes(range(256)) * 9
    for size in (1, 7, 4096):
        assert warc.unchunked(warc.chunked(body, size)) == body
    assert warc.unchunked(warc.chunked(b"", 5)) == b""
    assert warc.unchunked(b"3;name=x\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    for broken in (b"", b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\n", b"3\r\nabc\r\n", b"0\r\n", b"5\r\nab\r\n0\r\n\r\n"):
        assert warc.unchunked(broken) is None


# --- 12

TURN = "conv_id long, turn long, role string, text string, path string, at int, n long, source string"


@pytest.fixture(scope="module")
def talks(spark):
    """Shared first turns, equal conversations, nulls, ties, repeated rows, one long conversation."""
    rng = random.Random(4)
    rows = []
    for c in range(-25, 140):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi there", "a b\tc", "", "ünder   x"])))
    rows += [(200 + c, t, "user", f"same {t}") for c in range(60) for t in range(12)]  # a hot conversation
    rows += [(400 + c, t, "user", "common" if t < 3 else f"{c} {t}") for c in range(40) for t in range(6)]  # hot first turns
    rows += [(c, t, "user", f"long {t}") for c in (600, 601, 603) for t in range(18)]
    rows += [(601, 18, "user", "more"), (700, None, "user", "first"), (700, 5, None, None), (700, 5, "a", None), (700, 5, "a", "b"), (700, 5, "a", "b"),
             (701, 1, "user", "x"), (None, 1, "user", "lost"), (None, None, None, None), (722, 0, "user", "gone"), (723, 0, "user", "z")]
    return spark.createDataFrame([(*r, "p", 1, 2, "s") for r in rows], TURN)


def want_trie(rows):
    talks = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            text = r.text or ""
            talks[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", hashlib.md5(text.encode()).digest(), text))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in talks.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:])
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, seq in made.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * own
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, ())))).encode()).hexdigest()) for n, m in members.items()) if members else []


@pytest.mark.parametrize("base, local, run", [(8, 400_000, 1024), (2, 10, 3), (3, 0, 1)])
def test_trie_equals_brute_force(talks, monkeypatch, base, local, run):
    monkeypatch.setattr(trie, "RUN", run)
    got = trie.trie(trie.rebuilt(trie.turn_lists(talks)), base, local) if local else None
    if got is None:  # every group too large for a task: all levels on Spark
        short = talks.filter("conv_id IS NULL OR conv_id NOT BETWEEN 600 AND 603")
        got, talks = trie.trie(trie.rebuilt(trie.turn_lists(short)), base, local), short
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=repr) == sorted(want_trie(talks.collect()), key=repr)


def test_trie_without_rows(spark):
    assert trie.trie(trie.rebuilt(trie.turn_lists(spark.createDataFrame([], TURN)))).count() == 0


def test_parents_without_broadcast(talks, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "HEAVY_KEYS", 20)
    got = trie.trie(trie.rebuilt(trie.turn_lists(talks)), 4, 100)
    want = {(r[0], r[1]): r[2] for r in want_trie(talks.collect())}
    assert {(r.conv_id, r.depth): r.parent_conv_id for r in got.collect()} == want


# --- 13

VEC = "vec_id long, embedding array<double>, label int, v string, akey int, slot long, hits string"


@pytest.fixture(scope="module")
def vectors(spark):
    """Ties, copies, odd components, long vectors, scores beyond a double's integers."""
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5, 1.0, 2.0]) for _ in range(6)], rng.randint(0, 3)) for i in range(400)]
    rows += [(1000 + i, [1.0] * 6, i % 4) for i in range(60)]  # a hot vector
    rows += [(50, None, 1), (51, [1.0, None, 2.0], 1), (52, [float("nan")], 1), (53, [float("inf")], 1), (None, [1.0], 1), (2000, [1.0], None),
             (2050, [], 2), (2100, [3.0] * 9, 2), (2100, [3.0] * 9, 2), (2100, [2.0] * 9, 3), (2101, [2.5], 3), (2150, [-5.0] * 6, 77)]
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VEC)


def want_negatives(rows, every, n_pos, n_neg, low, high):
    sound = set()
    for r in rows:
        if r.vec_id is not None and r.label is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding):
            sound.add((r.vec_id, r.label, tuple(math.floor(256 * x) for x in r.embedding)))
    out = []
    for a, label, v in sound:
        if a % every:
            continue
        others = sorted((-max(1 - 2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(v, w)))), b, m) for b, m, w in sound)
        for p, b, _ in [o for o in others if o[2] == label and o[1] != a][:n_pos]:
            fit = [o for o in others if o[2] != label and low * -p <= 100 * -o[0] <= high * -p][:n_neg]
            out += [(a, b, n + 1, o[1], -p, -o[0]) for n, o in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("sizes", [None, (3, 7, 2, 2, 2)])
def test_negatives_equal_brute_force(vectors, monkeypatch, sizes):
    for name, n in zip(("ANCHOR_ROWS", "BLOCK_ROWS", "CELL_ANCHORS", "CELL_BLOCKS", "GROUP"), sizes or ()):
        monkeypatch.setattr(negatives, name, n)
    rows = vectors.collect()
    for n_pos, n_neg, low, high in [(5, 3, 50, 95)] if sizes else [(5, 3, 50, 95), (9, 40, 0, 100)]:
        got = found(negatives.mine(vectors, F.col("vec_id") % 50 == 0, None, n_pos, n_neg, low, high))
        assert got == want_negatives(rows, 50, n_pos, n_neg, low, high) and got


def test_great_scores_are_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.randint(1, 6) * 2.0 ** 20 + rng.randint(0, 3) / 256 for _ in range(3)], i % 3) for i in range(40)]
    rows += [(i, [1e300, -1e300 * (i % 2), 3.0], i % 3) for i in range(40, 46)]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VEC)
    got = found(negatives.mine(df, F.col("vec_id") % 5 == 0, None, 5, 3))
    assert got == want_negatives(df.collect(), 5, 5, 3, 50, 95) and got


def test_windows_and_empty_tables(spark, vectors):
    for p in range(-50, 300):
        lo, up = negatives.window(p, 50, 95)
        assert [n for n in range(-400, 400) if 50 * p <= 100 * n <= 95 * p] == list(range(lo, up + 1))
    assert negatives.mine(vectors.limit(0), F.lit(True)).count() == 0
    assert negatives.mine(vectors, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(vectors, F.lit(True), None, 5, 3, 95, 50)
