"""Operators that compare documents, against brute force."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docprep.llm import chat_format, components, exact_dedup, html_extract, jpeg, simhash, suffix_dedup


def texts(seed, n):
    r = random.Random(seed)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randint(90, 400))) for _ in range(8)]
    out = []
    for _ in range(n):
        t = ""
        for _ in range(r.randint(0, 5)):
            p, a = r.choice(passages), r.randint(0, 60)
            t += p[a : a + r.randint(80, 300)] if r.random() < 0.5 else "".join(r.choice("xyz ") for _ in range(r.randint(0, 120)))
        out.append(t)
    return out


# --- exact dedup


def groups_by_text(rows):
    out = {}
    for i, t in rows:
        out.setdefault(t or "", []).append(i)
    return {i: (max(g), len(g)) for g in out.values() for i in g}


@pytest.mark.parametrize("width", [16, 1])
def test_exact_duplicates(spark, width):
    r = random.Random(1)
    long_ = ["".join(r.choice("abcdefgh \n") for _ in range(n)) for n in (3, 700, 5000, 40_000)]
    rows = [(i, t) for i, t in enumerate([None, "", *long_, *long_, long_[3] + "x", "x" + long_[3], long_[2][:-1], "é" * 900, "é" * 900])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).withColumn("recipe", F.lit(1))
    out = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs, fingerprint_bytes=width).collect()}
    for i, (keep, n) in groups_by_text(rows).items():
        assert (out[i].keep_id, out[i].group_size, out[i].kept) == (keep, n, i == keep)
        assert out[i].text_sha256 == hashlib.sha256((rows[i][1] or "").encode()).hexdigest()
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_chunks_cover_the_text_and_depend_on_it_alone():
    r = random.Random(2)
    ts = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 511, 40_000, 100)]
    together = exact_dedup.chunk_ends(ts)
    assert together == [exact_dedup.chunk_ends([t])[0] if t else [] for t in ts]
    assert [e[-1] if e else 0 for e in together] == [len(t) for t in ts]
    assert all(b - a <= exact_dedup.MAX_CHUNK for e in together for a, b in zip([0, *e], e, strict=False))
    assert len(exact_dedup.chunk_ends([bytes(100_000)])[0]) >= 6


def test_repeated_rows_of_an_id(spark):
    rows = spark.createDataFrame([(5, "A"), (5, "A"), (5, "B"), (9, "B"), (None, "C"), (None, "D"), (2, "D")], "doc_id long, text string")
    out = sorted(((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(rows).collect()))
    assert out == [(0, 0, 1, True), (0, 2, 2, False), (2, 2, 2, True), (5, 5, 2, True), (5, 5, 2, True), (5, 9, 2, False), (9, 9, 2, True)]


def test_groups_of_many_rows(spark, monkeypatch):
    """Groups over the limit are joined by broadcast, the rest by a shuffle."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 500).cast("string"))).alias("text"))
    out = exact_dedup.exact_duplicates(docs)
    assert out.where("text_sha256 = sha2('hot', 256)").agg(F.min("group_size"), F.max("keep_id"), F.count("*")).first()[:] == (1500, 2998, 1500)
    assert out.count() == 3000 and out.where("kept").count() == 251
    assert simhash.near_duplicates(docs).where("component_id = 0").count() >= 1500


# --- simhash


def brute_fingerprint(text, n=4):
    import xxhash

    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(fps, radius):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for x in ids:
        for y in ids:
            if x < y and bin(fps[x] ^ fps[y]).count("1") <= radius:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("radius", "block"), [(4, 2048), (4, 3), (2, 2), (3, 2048)])
def test_near_duplicates(spark, radius, block):
    r = random.Random(radius)
    words = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    base = [r.choices(words, k=r.choice([3, 20, 200])) for _ in range(15)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "öne Ä")]
    for i in range(120):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 1, 1, 2])):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1))
    out = {r.doc_id: r for r in simhash.near_duplicates(docs, radius=radius, block=block).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    assert {i: x.fingerprint for i, x in out.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: x.component_id for i, x in out.items()} == brute_components(fps, radius)


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(4)
    r = random.Random(3)
    for _ in range(20_000):
        bits = 0
        for b in r.sample(range(64), r.randint(0, 4)):
            bits |= 1 << b
        assert any(bits & m % (1 << 64) == 0 for m in masks)


def test_fingerprint_ties_and_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(rows).collect()] == [1, 1, 1]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (200, 201), (201, 200), (5, 5)] + [(300, 300 + i) for i in range(1, 50)]
    out = {r.node: r.root for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 1 for i in range(2, 61)} | {101: 100, 103: 100, 201: 200} | {300 + i: 300 for i in range(1, 50)}
    assert out == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables_that_grow_are_not_broadcast(spark, tmp_path):
    """Each row of a table of small files makes 31; Spark goes by the files, and would send the keys to the driver."""
    spark.range(3000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("rep")).write.parquet(f"{tmp_path}/nodes")
    spark.range(1, 3000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")).write.parquet(f"{tmp_path}/links")
    edges = spark.read.parquet(f"{tmp_path}/links")

    def joins(df):
        return [kind for kind in ("BroadcastHashJoin", "SortMergeJoin") for _ in range(df._jdf.queryExecution().sparkPlan().toString().count(kind))]

    assert joins(simhash.links(spark.read.parquet(f"{tmp_path}/nodes"), 4)) == ["SortMergeJoin"]
    # Only the busy nodes, whose number is bounded, are.
    assert joins(components._with_least(edges, edges.toDF("a", "m"), 3000)) == ["BroadcastHashJoin"] * 2 + ["SortMergeJoin"]


# --- suffixes


def brute_repeats(rows, w=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - w + 1):
            if b[p : p + w] in seen:
                gone[p : p + w] = [True] * w
            seen.add(b[p : p + w])
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def test_repeats(spark):
    rows = [(i * 7 % 200, t) for i, t in enumerate(texts(3, 200))]
    rows += [(1000, None), (1001, "a" * 500), (1002, "a" * 150), (1003, "ab" * 300), (1004, ""), (1005, "é" * 300), (1006, "x" + "é" * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("blk", F.lit(1)).withColumn("n_removed", F.lit("x"))
    out = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, block_bytes=4000).collect()}
    assert out == brute_repeats(rows)


def test_repeats_keep_characters_whole(spark):
    rows = [(1, "x" + "é" * 120), (2, "é" * 300 + "tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, with_text=True, carry=("source",)).collect()}
    assert out[1].source == "s" and out[2].kept_text.endswith("tail") and "�" not in out[2].kept_text


def test_repeats_of_empty_and_repeated_rows(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    same = spark.createDataFrame([(None, "q" * 10 + "w" * 120), (4, "q" * 10 + "w" * 120), (4, "q" * 10 + "w" * 120)], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffix_dedup.remove_repeats(same).collect()) == [119, 130, 130]


def test_slices_of_long_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 300)
    rows = [(i, t.encode()) for i, t in enumerate(texts(5, 40))]
    block = suffix_dedup.Block([i for i, _ in rows], [t for _, t in rows], 100)
    keys = block.sample_keys(64)
    pieces = block.pieces(keys, np.zeros(len(np.unique(keys)), bool), np.zeros(2, bool), 3)
    gone = [suffix_dedup.gone_rows(suffix_dedup.piece_rows({b: p}, block.ids, 0), 100) for b, p in pieces.items()]
    want = brute_repeats([(i, t.decode()) for i, t in rows])
    assert [int(g.sum()) for g in suffix_dedup.covered(block, pa.concat_tables(gone))] == [want[i][1] for i, _ in rows]


@pytest.mark.parametrize("bits", [8, 64])
def test_equal_hashes_are_not_taken_for_equal_bytes(spark, monkeypatch, bits):
    """Fingerprints of one byte tie everywhere, and all strings fall in one bucket: the result stays."""
    if bits == 8:
        monkeypatch.setattr(suffix_dedup, "_mixed", lambda h: h & np.uint64(3) | h >> np.uint64(62) << np.uint64(56))
    rows = list(enumerate(texts(11, 80)))
    block = suffix_dedup.Block([i for i, _ in rows], [t.encode() for _, t in rows], 100)
    keys = block.sample_keys(bits)
    pieces = block.pieces(keys, np.ones(len(np.unique(keys)), bool), np.zeros(2, bool), 3)
    gone = [suffix_dedup.gone_rows(suffix_dedup.piece_rows({b: p}, block.ids, 0), 100) for b, p in pieces.items()]
    want = brute_repeats(rows)
    assert [int(g.sum()) for g in suffix_dedup.covered(block, pa.concat_tables(gone))] == [want[i][1] for i, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, block_bytes=3000, rank_bits=8).collect()}
    assert out == want


@pytest.mark.parametrize("seed", range(12))
def test_suffixes_of_a_bucket_in_bounded_memory(seed):
    """Long ties by cover ranks against brute force: periodic texts, many different ends after one beginning, positions at random."""
    r = random.Random(seed)
    if seed % 3 == 0:
        t = "".join(r.choice(["ab" * 60, "a" * 150, "abc" * 50, r.choice("xyz") * 30]) for _ in range(30))
    elif seed % 3 == 1:
        head = "".join(r.choice("abcd") for _ in range(57))
        ends = ["".join(r.choice("ab") for _ in range(60)) for _ in range(150)]
        t = "".join(head + e + "-" * (k % 5) for k, e in enumerate(ends + ends[:90]))
    else:
        t = "".join(r.choice(["lorem ipsum ", "dolor ", "sit amet "]) for _ in range(800))
    text = np.frombuffer(t.encode(), np.uint8)
    at = np.array(sorted(r.sample(range(len(t) - 99), (len(t) - 99) * 2 // 3)))
    rank = np.array(r.sample(range(10**6), len(at)))
    got = suffix_dedup.repeated_suffixes(text, at, rank)
    least = {}
    for p, k in zip(at.tolist(), rank.tolist()):
        least[t[p : p + 100]] = min(k, least.get(t[p : p + 100], 1 << 30))
    assert got.tolist() == [k > least[t[p : p + 100]] for p, k in zip(at.tolist(), rank.tolist())]


def test_cover_has_all_differences():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


# --- media


def test_jpeg_round_trip():
    r = random.Random(1)
    payloads = [bytes(r.randrange(256) for _ in range(64 * n)) for n in (1, 2, 6, 7, 100, 333)] + [bytes(64), b"\xff" * 640]
    images = jpeg.decode(jpeg.encode(payloads))
    assert [jpeg.payload_of(i) for i in images] == payloads
    assert all(jpeg.to_rgb(i).shape == (i.height, i.width, 3) for i in images)
    with pytest.raises(ValueError):
        jpeg.encode([b"x"])
    assert jpeg.decode([]) == []


def test_images_of_any_payload(monkeypatch):
    """Where the height would pass the format's bound the image is wider; here the bound is three MCUs."""
    assert all(h <= 4095 and w * h * 6 >= n for n in (1, 786_432, 786_433, 10**7, 10**8) for w, h in [jpeg.shape(n)])
    monkeypatch.setattr(jpeg, "MOST", 3)
    monkeypatch.setattr(jpeg, "WIDE", 2)
    r = random.Random(2)
    payloads = [bytes(r.randrange(256) for _ in range(64 * n)) for n in (6, 36, 37, 54)]
    images = jpeg.decode(jpeg.encode(payloads))
    assert [jpeg.payload_of(i) for i in images] == payloads and max(i.height for i in images) == 48 and max(i.width for i in images) == 48
    with pytest.raises(ValueError):
        jpeg.shape(6 * 3 * 3 + 1)


def test_colour_against_the_formula():
    """Planes, chroma and colour of a random image, sample by sample."""
    r = random.Random(3)
    image = jpeg.decode(jpeg.encode([bytes(r.randrange(256) for _ in range(64 * 12))]))[0]
    rgb, wide = jpeg.to_rgb(image), image.mcus[0]

    def sample(c, x, y, blocks_wide):
        z = np.zeros(64)
        z[jpeg.ZIGZAG] = image.planes[c][(y // 8) * blocks_wide + x // 8]
        f = lambda u: math.sqrt(0.125) if u == 0 else 0.5
        s = sum(z[8 * v + u] * f(u) * f(v) * math.cos((2 * (x % 8) + 1) * u * math.pi / 16) * math.cos((2 * (y % 8) + 1) * v * math.pi / 16) for u in range(8) for v in range(8))
        return min(255, max(0, round(s + 128)))

    for _ in range(60):
        x, y = r.randrange(image.width), r.randrange(image.height)
        lum, cb, cr = sample(1, x, y, 2 * wide), sample(2, x // 2, y // 2, wide) - 128, sample(3, x // 2, y // 2, wide) - 128
        want = [lum + 1.402 * cr, lum - 0.344136 * cb - 0.714136 * cr, lum + 1.772 * cb]
        assert all(abs(a - min(255, max(0, b))) <= 2.5 for a, b in zip(rgb[y, x].tolist(), want, strict=True))


def test_stored_tensors(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x" * 900), (2, None)], "doc_id long, text string")
    rows = jpeg.store_tensors(docs, str(tmp_path / "t")).collect()
    assert len(rows) == 2 and all(len(r.rgb) == 3 * r.height * r.width for r in rows)


def test_inverse_transform_is_orthonormal():
    assert np.allclose(jpeg.BASIS @ jpeg.BASIS.T, np.eye(64), atol=1e-5)
    flat = np.zeros(64, np.float32)
    flat[0] = 80
    assert np.allclose(flat @ jpeg.BASIS, 10)


def _bits_of(pairs):
    s = "".join(format(v, f"0{n}b") if n else "" for v, n in pairs)
    s += "1" * (-len(s) % 8)
    return bytes(int(s[i : i + 8], 2) for i in range(0, len(s), 8)).replace(b"\xff", b"\xff\x00")


def test_runs_bands_and_refinement_of_a_hand_made_file():
    """One MCU; AC of the first Y block has zero runs, an end-of-band run over blocks, and a refinement that adds values."""
    counts, symbols = jpeg.table_lengths(9), (0x00, 0x01, 0x11, 0x02, 0x10, 0xF0, 0x21, 0x20, 0x31)
    dc, ac = jpeg.codes(jpeg.table_lengths(3), (0, 1, 2)), jpeg.codes(counts, symbols)
    seg = jpeg._segment
    out = b"\xff\xd8" + seg(0xDB, b"\x00" + b"\x01" * 64) + seg(0xC2, b"\x08\x00\x10\x00\x10\x03" + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    out += seg(0xC4, bytes([0, *jpeg.table_lengths(3), 0, 1, 2])) + seg(0xC4, bytes([0x10, *counts, *symbols]))
    out += jpeg._header([1, 2, 3], 0, 0, 0, 0) + _bits_of([dc[1], (1, 1), dc[0], dc[2], (0, 2), dc[0], dc[0], dc[0]])
    # First pass, values doubled: block 0: k=1: +1, one zero, k=3: -1, end; then an end-of-band run of 2 + 1 blocks.
    out += jpeg._header([1], 1, 63, 0, 1) + _bits_of([ac[0x01], (1, 1), ac[0x11], (0, 1), ac[0x00], ac[0x10], (1, 1)])
    # Refinement: block 0: correct k=1 (+1), pass the zero at 2, correct k=3 (0), pass the zero at 4, new -1 at 5, end; then the rest.
    out += jpeg._header([1], 1, 63, 1, 0) + _bits_of([ac[0x21], (0, 1), (1, 1), (0, 1), ac[0x00], ac[0x10], (1, 1)]) + b"\xff\xd9"
    image = jpeg.decode([out])[0]
    y = image.planes[1]
    assert y[:, 0].tolist() == [1, 1, -2, -2]
    assert y[0, 1:7].tolist() == [3, 0, -2, 0, -1, 0] and not y[0, 7:].any() and not y[1:, 1:].any()


def test_media_tables(spark):
    rows = [(1, "hé" * 40), (2, None), (3, ""), (4, "hé" * 40), (5, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit(1))
    out = {r.doc_id: r for r in jpeg.media_digests(docs).collect()}
    for i, t in rows:
        p = jpeg.payload((t or "").encode())
        assert out[i].payload_sha256 == hashlib.sha256(p).hexdigest() and out[i].payload_bytes == len(p) and len(p) % 64 == 0
    assert tuple(out[1])[1:] == tuple(out[4])[1:] and tuple(out[2])[1:] == tuple(out[3])[1:]
    back = {r.doc_id: r for r in jpeg.read_media(jpeg.store_media(docs)).collect()}
    assert back[5].payload == jpeg.payload(b"x" * 5000) and len(back[5].rgb) == 3 * back[5].height * back[5].width
    assert jpeg.media_digests(docs.limit(0)).count() == 0


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<{tag}><header><h1>{title}</h1></header><p>First &amp; <b>bold</b>\n text &eacute;&#8212;<br>line</p>{more}<aside>Related</aside></{tag}>
<div id="comments"><p>Nice post</p></div><form>Name <input></form><div class="ads">Buy</div><footer>&copy; 2026</footer></body></html>"""


def test_main_text():
    pages = [PAGE.format(tag="article", title=f"Title {i}", more="".join(f"<p>Par {k}" for k in range(i))) for i in range(4)]
    out = html_extract.extract(pages)
    assert out[2] == "Title 2\n\nFirst & bold text é— line\n\nPar 0\n\nPar 1"
    assert out[0] == "Title 0\n\nFirst & bold text é— line"


def test_main_text_without_article():
    pages = [f"<html><body><div class=menu>Menu</div><div>Same line</div><div><p>Story {i}</p></div></body></html>" for i in range(5)]
    assert html_extract.extract(pages) == [f"Story {i}" for i in range(5)]


def as_regex(node):
    if node.name == "#":
        body = "#"
    else:
        inner = "".join(map(as_regex, node.kids))
        body = f"(?:{inner})" if node.name[0] == "(" else f"(?:{re.escape('<' + node.name + '>')}{inner}{re.escape('</>')})"
    return body + ("+" if node.repeated else "") if not node.optional else f"(?:{body}{'+' if node.repeated else ''})?"


def as_tokens(node):
    return "#" if node.name == "#" else f"<{node.name}>{''.join(map(as_tokens, node.kids))}</>"


def plain_tree(page):
    """The page's tree without folding: what the wrapper's expression has to match."""
    root, stream = html_extract.tree_of(page)
    for n in html_extract.walk(root):
        if n.name in ("div", "section") and all(k.name == "#" for k in n.kids):
            n.name += "#"
    return root


def random_page(r, depth=0):
    out = ""
    for _ in range(r.randint(0, 4)):
        kind = r.choice(["p", "div", "ul", "dl", "h2", "text", "hr", 'div class="x"'])
        if kind == "text":
            out += r.choice("abc")
        elif kind == "hr":
            out += "<hr>"
        elif kind == "ul":
            out += "<ul>" + "".join(f"<li>{r.choice('ab')}</li>" for _ in range(r.randint(0, 3))) + "</ul>"
        elif kind == "dl":
            out += "<dl>" + "".join("<dt>k</dt><dd>v</dd>" for _ in range(r.randint(1, 3))) + "</dl>"
        else:
            out += f"<{kind}>{random_page(r, depth + 1) if depth < 2 and kind != 'p' else r.choice('ab')}</{kind.split()[0]}>"
    return out


@pytest.mark.parametrize("seed", range(150))
def test_wrapper_matches_every_page_it_was_inferred_from(seed):
    """The inferred expression, run as a regular expression by brute force, accepts each page's token stream."""
    r = random.Random(seed)
    pages = [random_page(r) for _ in range(r.randint(1, 5))]
    pattern = re.compile(as_regex(html_extract.infer(pages)))
    assert all(pattern.fullmatch(as_tokens(plain_tree(p))) for p in pages)


def test_wrapper_has_slots_repeats_and_options():
    a = "<ul><li>1</li><li>2</li></ul><p>x</p><i>same</i><dl><dt>k<dd>v<dt>k<dd>w</dl>"
    b = "<ul><li>3</li></ul><hr><p>y</p><i>same</i><dl><dt>k<dd>z</dl>"
    assert html_extract.expression(html_extract.infer([a, a, b])) == (
        "( <page> ( <ul> ( <li> #TEXT </> )+ </> ) <hr/>? ( <p> #TEXT </> ) #'same' ( <dl> ( ( <dt> #'k' </> ) ( <dd> #TEXT </> ) )+ </> ) </> )"
    )


def test_wrapper_decides():
    """What goes and stays by the host's pages alone: the same page gives other text with other neighbours."""
    page = "<body><div><p>Line of all</p><p>Story {0}</p><h2>More {0}</h2></div><div class='x-related'>{1}</div></body>"
    pages = [page.format(i, f"Essay {i}") for i in range(4)]
    assert html_extract.extract(pages)[1] == "Line of all\n\nStory 1\n\nMore 1"
    marked = "<article><p>T {0}</p><div class='related-work'>Prose on {0}</div><section class='share-price'>Fell by {0}</section><div class='cookie-notice'>We use cookies</div><div class='related-posts'>See <a href=x>post number {0}</a></div></article>"
    assert html_extract.extract([marked.format(i) for i in range(4)])[2] == "T 2\n\nProse on 2\n\nFell by 2"
    assert "We use cookies" in html_extract.extract([marked.format(2)])[0]
    bare = "<body><div>Shop of Ann for all sorts of tea</div><div><h3>Offer</h3><p>Tea {0}</p></div>"
    assert html_extract.extract([bare.format(i) for i in range(3)])[0] == "Tea 0"
    assert html_extract.extract([bare.format(0)])[0] == "Shop of Ann for all sorts of tea\n\nOffer\n\nTea 0"
    assert html_extract.main_text(html_extract.Node("page"), "<p>alone</p>") == "alone"


TEMPLATES = ["<div class=post><h1>{0}</h1><p>{1}</p><table>{2}</table><p>{3}</p></div>", "<div class=post><h1>{0}</h1><p>{1}</p><div class=body>{2}</div><p>{3}</p></div>", "<div class=header><h1>{0}</h1></div><div><p>{1}</p></div>{2}<p>{3}</p>"]


@pytest.mark.parametrize("template", TEMPLATES)
@pytest.mark.parametrize("around", ["{}", "<div id=top>Shop of Ann</div><div>{}</div><div>All rights of Ann</div>", "<div class=menu><a href=a>One</a> <a href=b>Two</a></div>{}"])
def test_an_unmarked_article_stays_whole(template, around):
    """What a template is filled with is the article; what stands around it on all pages isn't."""
    r = random.Random(template + around)
    pages, want = [], []
    for k in range(8):
        parts = [" ".join(r.choices("tea cup pot lid mug jar".split(), k=r.randint(3, 9))) + f" {k} {i}" for i in range(3 + r.randint(2, 30))]
        middle = "".join(f"<tr><td>{p}</td></tr>" if "table" in template else f"<p>{p}</p>" for p in parts[2:-1])
        pages.append("<html><body>" + around.format(template.format(parts[0], parts[1], middle, parts[-1])) + "</body></html>")
        want.append("\n\n".join(parts))
    assert html_extract.extract(pages) == want


def test_classes_that_articles_use_are_hints():
    page = '<article><div class="header"><h1>T {0}</h1></div><p>Text {0}</p><div class="menu"><p>Soup {0}</p></div><div class="social">Club of {0}</div><div class="comments">Reader {0}</div><div class="social"><a href=x>Share {0}</a></div><div class="menu">Same on all</div></article>'
    assert html_extract.extract([page.format(i) for i in range(5)])[1] == "T 1\n\nText 1\n\nSoup 1\n\nClub of 1"
    assert html_extract.extract([page.format(1)])[0] == "T 1\n\nText 1"


def test_another_template_on_the_host_has_its_own_wrapper():
    pages = [PAGE.format(tag="article", title=f"T{i}", more="") for i in range(9)] + ["<body><nav>x</nav><div><p>Quite another page</p></div></body>"]
    assert html_extract.extract(pages)[9] == "Quite another page"


@pytest.mark.parametrize("unit", ["<a ", '<a ="', "<div>", "<b>", "<p><b>", "</div>", "<script>", "<!--", "<a b='", "&amp;<", "<div><p>x", "<i class=ad>"])
def test_hostile_pages_take_linear_time(unit):
    start = time.process_time()
    html_extract.main_text(html_extract.Node("page"), unit * (1_000_000 // len(unit)))
    assert time.process_time() - start < 20


def test_irregular_and_long_pages():
    r = random.Random(1)
    pages = ["".join(f"<{t}>x{i}</{t}>" for i, t in ((i, r.choice("div p ul h2 section table pre dl".split())) for i in range(8000))) for _ in range(2)]
    start = time.process_time()
    out = html_extract.extract([f"<article>{p}</article>" for p in pages])
    assert time.process_time() - start < 20
    assert all(len(t.split()) == 8000 for t in out)
    long_ = f"<article>{'<p>word &amp; word</p>' * 60_000}</article>"  # beyond the sample's bound
    assert len(html_extract.extract([long_])[0].split()) == 180_000
    assert html_extract.extract(["<div>" * 5000 + "deep"])[0] == "deep"


def test_pages_tables(spark):
    rows = [(1, "http://a.example/x", PAGE.format(tag="article", title="A", more="")), (2, None, None), (3, "bad url", ""), (4, "http://A.example:80/y", "<p>unclosed <b>x <!-- c"), (4, "http://A.example:80/y", "<p>unclosed <b>x <!-- c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = html_extract.main_texts(pages).collect()
    assert len(out) == 5 and {r.page_id: r.text for r in out}[2] == "" and all(r.n_chars == len(r.text) for r in out)
    assert {r.page_id: r.text for r in out}[4] == "unclosed x"
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_pages_without_article_by_host(spark):
    """Copies count once, statistics are of the host and not of a task, and no page is emptied."""
    head = "<html><body><div class=menu>Menu</div><div>Same line</div>"
    rows = [(i, "http://a.example/", f"{head}<div><p>Story {i}</p></div></body></html>") for i in range(100)]
    rows += [(200 + i, "http://b.example/", f"{head}<div><p>Copied</p></div></body></html>") for i in range(40)] + [(300, "http://b.example/", f"{head}<div><p>Other</p></div></body></html>")]
    rows += [(400 + i, "http://c.example/", f"<html><body><p>All shared</p>{'<hr>' * i}</body></html>") for i in range(4)]
    out = {}
    for parts in (1, 60):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            out[parts] = {r.page_id: r.text for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[1] == out[60]
    assert all(out[1][i] == f"Story {i}" for i in range(100))
    assert {out[1][200 + i] for i in range(40)} == {"Same line\n\nCopied"} and out[1][300] == "Same line\n\nOther"
    assert all(out[1][400 + i] == "All shared" for i in range(4))


def test_wrappers_come_from_all_pages(spark):
    """Two pages of hundred, or one very long page, tell that a text isn't fixed."""
    page = "<html><body><div>Site of Ann</div><div><h2>{0}</h2><p>Story {1}</p></div></body></html>"
    few = [page.format("Edition two" if i in (31, 77) else "Edition one", i) for i in range(100)]
    long_ = [page.format("Edition one", i) for i in range(5)] + [page.format("Edition two", "long " * 60_000)]
    rows = [(i, "http://a.example/", p) for i, p in enumerate(few)] + [(1000 + i, "http://b.example/", p) for i, p in enumerate(long_)]
    got = {r.page_id: r.text for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for first, pages in ((0, few), (1000, long_)):
        assert [got[first + i] for i in range(len(pages))] == html_extract.extract(pages)
        assert got[first + 1] == "Edition one\n\nStory 1"


def test_classes_of_a_host_are_aligned_in_parts(spark, monkeypatch):
    """Irregular pages: the tables give what the lists give, and in several rounds texts don't depend on order or partitions."""
    r = random.Random(3)
    hosts = {f"h{h}.example": [random_page(r) for _ in range(40)] for h in range(6)}
    rows = [(100 * h + i, f"http://{host}/", p) for h, (host, pages) in enumerate(hosts.items()) for i, p in enumerate(pages)]

    def texts(rows, parts):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        return {x.page_id: x.text for x in html_extract.main_texts(df).collect()}

    got = texts(rows, 3)
    for h, pages in enumerate(hosts.values()):
        assert [got[100 * h + i] for i in range(40)] == html_extract.extract(pages)
    monkeypatch.setattr(html_extract, "FAN", 3)
    several = texts(rows, 1)
    assert several == texts(rows[::-1], 7) and len(several) == len(rows)


@pytest.mark.parametrize("seed", range(40))
def test_pruned_wrappers_decide_the_same(seed):
    r = random.Random(seed)

    def some(depth=0):
        out = ""
        for _ in range(r.randint(0, 5)):
            kind = r.choice(["nav", "div class=menu", 'div class="x-related"', "article", "header", "main", "div class=social", "p", "div", "li", "text", "text", "link"])
            if kind in ("text", "link"):
                out += r.choice(["Same line", f"x{r.randint(0, 99)}"]) if kind == "text" else f"<a href=x>l{r.randint(0, 3)}</a>"
            else:
                out += f"<{kind}>{some(depth + 1) if depth < 4 else r.randint(0, 9)}</{kind.split()[0]}>"
        return out

    pages = [some() for _ in range(r.randint(1, 7))]
    wrapper = html_extract.infer(pages)
    less = html_extract.pruned(html_extract.unpacked(html_extract.packed(wrapper)))
    assert all(html_extract.main_text(wrapper, p) == html_extract.main_text(less, p) for p in [*pages, some(), some()])


# --- chats


def test_chats(spark):
    call = '{"tool_calls":[{"id":"a","name":"search","arguments":{"query":"x","limit":3}},{"id":"b","name":"search","arguments":"{\\"limit\\": \\"3\\"}"}],"content":"hi"}'
    rows = [
        (1, 0, "assistant", call), (1, 1, "tool", '{"tool_call_id":"a","content":"r"}'), (2, 0, "tool", '{"tool_call_id":"z","content":"early"}'),
        (2, 3, "assistant", '{"tool_calls":[{"id":"z","name":"nope","arguments":{"b":1,"a":{"d":1,"c":[2, 1]}}}]}'), (2, 4, "tool", '{"tool_call_id":"none"}'),
        (None, None, None, None), (3, 1, "user", '{"tool_calls":[]}'), (3, 2, "assistant", "{not json"),
    ]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("calls", F.lit(1))
    out = {(r.conv_id, r.turn): r for r in chat_format.format_chats(d).collect()}
    assert len(out) == len(rows)
    assert (out[1, 0].n_calls, out[1, 0].n_valid, out[1, 0].n_linked) == (2, 1, 1)
    assert out[1, 0].message_json == '{"content":"hi","role":"assistant","tool_calls":[{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search"},{"arguments":{"limit":"3"},"id":"b","name":"search"}]}'
    assert out[2, 0].is_linked_result and (out[2, 0].order_turn, out[2, 0].order_sub) == (3, 1)
    assert not out[2, 4].is_linked_result and out[2, 4].order_turn == 4
    assert '"arguments":{"a":{"c":[2,1],"d":1},"b":1}' in out[2, 3].message_json
    assert out[3, 2].message_json == '{"content":"{not json","role":"assistant"}'
    assert out[None, None].message_json == '{"content":"","role":"unknown"}'
    assert chat_format.format_chats(d.limit(0)).count() == 0
