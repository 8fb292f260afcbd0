"""The text operators against plain versions, on awkward rows, empty tables and the smallest data."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from headway.llm import bpe, decontaminate, langid, lmscore, neardup, page_text, quality, repeats, secret_scan, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return brute.corpus(spark).cache()


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_counts(docs, real):
    for table in (docs, real):
        got = sorted(tuple(r)[1:6] for r in quality.quality_rules(table).collect())
        assert got == sorted(brute.quality(r["text"]) for r in table.collect())


def test_quality_verdicts(docs):
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
    assert not any(kept[i] for i in (1, 2, 3, 4, 5, 14)) and kept[8]
    out = quality.cleaned(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {i for i, k in kept.items() if k}
    assert quality.cleaned(docs.limit(0)).count() == 0


def _verdicts(spark, texts):
    """Good lines of each text by the operator and by the statement."""
    from headway.llm import queries
    from tests.oracle import compare, connect

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    duck = connect(SF)
    got = quality.quality_rules(frame)
    duck.register("lines_given", frame.toPandas())
    duck.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM lines_given")
    assert compare(got, duck, queries.ORACLES["op10_quality_rules"]) == []
    return {r["doc_id"]: r["n_good_lines"] for r in got.collect()}


def test_lines_end_where_their_text_ends(spark):
    clean = [f"Line {i} says something plain about the town and its {i} streets." for i in range(20)]
    french = [f"Il a dit «oui», puis «non» et enfin «peut-être» quand on lui a posé la question numéro {i}." for i in range(20)]
    menu = [f"Home » News {i} » Sport » About us." for i in range(20)]
    long_line = ["One · two · three · four are the parts of this long line, " + "which goes on and on about each of them " * 3 + "to its end."]
    texts = ["\n".join(x) for x in (clean, [c + " " * 9 for c in clean], [c + "\t\r" for c in clean], [c + "”" * 9 for c in clean], french, menu, long_line,
                                   ["no end", "»»»", "..."], [""], [c[:-1] + "»" for c in clean])]
    assert _verdicts(spark, texts) == {0: 20, 1: 20, 2: 20, 3: 20, 4: 20, 5: 0, 6: 1, 7: 1, 8: 0, 9: 0}


def test_near_duplicates(docs, real):
    for width, percent in ((3, 85), (5, 80)):
        for table in (docs, real):
            rows = [(r["doc_id"], r["text"]) for r in table.collect() if r["doc_id"] is not None]
            got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(table, width, percent).collect()}
            got.pop(None, None)
            assert got == brute.groups(rows, width, percent)


def test_deduplicated_keeps_one(docs):
    out = neardup.deduplicated(docs)
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert out.columns == docs.columns and ids == [1, 2, 3, 4, 5, 8, 10, 11, 12, 13, 14]
    assert neardup.near_duplicates(docs.limit(0), 3, 85).count() == 0


def test_different_texts_under_one_id_all_stay(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(7, text(1)), (7, text(2)), (7, text(2)), (9, text(2)), (3, text(1)), (8, text(3)), (7, None)]
    out = neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["text"] or "") for r in out.collect()))
    # every text of 7 stays, 3 is the smallest of its group, 9 is a copy
    assert got == sorted([(3, text(1)), (7, ""), (7, text(1)), (7, text(2)), (8, text(3))])


def test_large_group_without_all_pairs(spark):
    """A bucket of many near copies that differ from each other in one word."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i % 190], f"x{i}", *base[i % 190 + 1:]])) for i in range(150)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {i: c for i, (_, c) in brute.groups(rows, 3, 85).items()}


def test_copies_of_different_depth_make_few_pairs(spark, monkeypatch):
    """Near copies of which many differ too much from each other: sketches refute those inside the buckets."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = [f"w{k}" for k in range(200)]
        for k in rng.sample(range(200), rng.randrange(12)):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    rows.append((400, rows[3][1] + " other end"))
    rows.append((400, "a text of its own under the same id"))
    made, verified = [], neardup._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(table.where("doc_id < 400"), 3, 85).collect()}
    assert got == {i: c for i, (_, c) in brute.groups(rows[:300], 3, 85).items()} and len(set(got.values())) > 1
    assert sum(made) < 1_000  # 44,850 pairs meet in buckets
    out = neardup.near_duplicates(table, 3, 85).where("doc_id = 400").collect()
    assert [r["component_id"] for r in out] == [got[3]] * 2  # one document of two texts


def test_shards_of_a_bucket_meet(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:i + 90], f"y{i}", *base[i + 91:]])) for i in range(0, 100, 2)]
    monkeypatch.setattr(neardup, "SHARD", 8)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 96).collect()}
    assert got == {i: c for i, (_, c) in brute.groups(rows, 3, 96).items()}


def test_sketches_refute_no_alike_pair():
    rng = np.random.default_rng(3)
    sets = []
    for size in (1, 3, 40, 600, 60_000):
        one = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
        for change in (0, 1, size // 30, size // 12, size // 3):
            sets.append(np.unique(np.concatenate([one[change:], rng.integers(0, 2**63, change, dtype=np.uint64)])))
    n = np.array([len(s) for s in sets])
    sketches = np.array([np.frombuffer(neardup.sketch(s, neardup.signature(s)), np.uint8) for s in sets])
    left, right = (x.ravel() for x in np.meshgrid(range(len(sets)), range(len(sets))))
    allowed = set(neardup.allowed_pairs(n, sketches, left, right, 85).tolist())
    for at, (a, b) in enumerate(zip(left, right, strict=True)):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 85 * (n[a] + n[b] - both):
            assert at in allowed
        elif 100 * both < 30 * (n[a] + n[b] - both):
            assert at not in allowed


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 70), (7, 7)]
    got = {r["node"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 70: 50, 100: 50}


def test_secrets(docs, real):
    kinds = (("assign", r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
             ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
    for table in (docs, real):
        texts = {}
        for r in table.collect():
            found = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, g, least) in enumerate(kinds)
                           for m in re.finditer(p, r["text"] or "", re.ASCII) if len(m[g]) >= least)
            texts[r["doc_id"]] = hashlib.sha256(",".join(x[2] for x in found).encode()).hexdigest()
        assert {r["doc_id"]: r["base_sha256"] for r in secret_scan.secret_scan(table).collect()} == texts


def test_random_string_is_found_and_masked(docs, real):
    both = docs.select("doc_id", "text").where("doc_id = 12").unionByName(real.select("doc_id", "text").where("doc_id > 20"))
    row = next(r for r in secret_scan.secret_scan(both).collect() if r["doc_id"] == 12)
    assert row["spans"] == "markov:4:27"
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert masked[11] == '[SECRET]" and [SECRET] then [SECRET] é password:abc end' and masked[1] is None
    assert secret_scan.redacted(docs.limit(0)).count() == 0


def test_short_digitless_and_parted_secrets(spark, real):
    """Planted random strings that have no digit, fewer than 20 characters or separators; ordinary words stay."""
    rng, letters = random.Random(4), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    draw = lambda signs, n: "".join(rng.choice(signs) for _ in range(n))
    planted = [*(draw(letters, 24) for _ in range(20)), *(draw(letters + "0123456789", 14) for _ in range(20)),
               *(":".join(draw(letters + "0123456789", 8) for _ in range(3)) for _ in range(20))]
    rows = [(10_000 + i, f"é password=abcdef12 internationalisations {v} is random") for i, v in enumerate(planted)]
    table = real.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["doc_id"]: r for r in secret_scan.secret_scan(table).collect()}
    right = [found[i]["spans"] == f"assign:2:19,markov:42:{42 + len(v)}" for i, v in zip(range(10_000, 10_060), planted, strict=True)]
    assert all(sum(right[i:i + 20]) >= 18 for i in (0, 20, 40))
    other = [r["n_markov"] for i, r in found.items() if i < 10_000]
    assert sum(other) <= 0.01 * len(other)


def test_secrets_in_texts_of_very_many_parts(spark):
    """Tokens of tens of thousands of parts and of a hundred thousand characters; a repeated group must not fill the stack."""
    rng = random.Random(5)
    drawn = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(100_000))
    texts = ["ab:" * 3_000, "ab:" * 70_000, "a.b. " * 30_000, "0f " * 30_000, drawn, "password" * 30_000, "token=" + "a=" * 30_000, "AKIA" * 30_000]
    frame = spark.createDataFrame([*((i, t) for i, t in enumerate(texts)), (99, "password=Xy12ab34")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secret_scan.secret_scan(frame).collect()}
    assert len(rows) == 9 and rows[99]["spans"] == "assign:0:17"
    assert rows[6]["spans"] == f"assign:0:{len(texts[6])}" and rows[7]["spans"] == f"access:0:{len(texts[7])}"
    assert all(rows[i]["n_assign"] == rows[i]["n_access"] == rows[i]["n_hex"] == 0 for i in range(6) if i != 4)


def test_candidates_are_those_of_the_greedy_pattern(spark):
    greedy = secret_scan.CANDIDATE.replace("++", "+").replace("*+", "*")
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab1_.:~ -é") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"regexp_extract_all(t, r'{secret_scan.CANDIDATE}', 0) AS found").collect()
    assert greedy != secret_scan.CANDIDATE
    assert all(r["found"] == [m[0] for m in re.finditer(greedy, r["t"], re.ASCII)] for r in found)


def test_language(docs, real):
    rows = {r["doc_id"]: r for r in langid.language_id(real).collect()}
    lang = {r["doc_id"]: r["lang"] for r in real.collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(held) == sorted(i for i, r in rows.items() if r["held_out"])
    assert np.mean([rows[i]["lang_pred"] == lang[i] for i in held]) >= 0.95
    odd = {r["doc_id"]: r for r in langid.language_id(docs).collect()}
    assert all(odd[i]["lang_pred"] == "und" for i in (1, 2, 3)) and all(0 <= r["score"] <= 1 for r in odd.values())
    assert langid.language_id(docs.limit(0)).count() == 0


def test_repeats(docs, real):
    for table in (docs, real):
        got = sorted(tuple(r)[1:] for r in repeats.repeated_bytes(table).collect())
        assert got == brute.repeats([r["text"] for r in table.collect()])
    assert repeats.repeated_bytes(docs.limit(0)).count() == 0


def test_planted_passages_are_removed(spark):
    """Passages of 400 bytes and more that repeat count as removed; texts without one stay whole."""
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    passage = words(60)
    rows = [(i, f"{words(80)} {passage} {words(20)}" if i % 2 else words(150)) for i in range(20)]
    got = {r["doc_id"]: r for r in repeats.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert got[i]["n_bytes"] == len(text) and (got[i]["n_removed"] >= len(passage)) == bool(i % 2) and (got[i]["n_removed"] > 0) == bool(i % 2)


def test_merge_of_transforms_is_the_transform_order():
    rng = random.Random(3)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))).encode() for _ in range(30)]
    a, b = repeats.Shard(strings[:13]), repeats.Shard(strings[13:])
    n = len(a.transform) + len(b.transform)
    suffix = [strings[o][p:] for o, p in zip([*a.owner, *(b.owner + 13)], [*a.offset, *b.offset], strict=True)]
    _, _, prefix = repeats.merged_blocks(a, b, np.zeros(n, np.int64), 8)
    # after k steps a suffix stands for the k symbols before it: the common prefix of the strings that end where it starts
    before = [strings[o][:p][::-1] for o, p in zip([*a.owner, *(b.owner + 13)], [*a.offset, *b.offset], strict=True)]
    for i in range(n):
        shared = max(next((k for k in range(9) if before[i][:k + 1] != before[j][:k + 1] or len(before[i]) <= k), 8) for j in range(n) if i != j)
        assert prefix[i] == min(8, shared)
    for shard, part in ((a, suffix[:len(a.transform)]), (b, suffix[len(a.transform):])):
        assert part == sorted(part) and len(shard.previous()) == len(part)


def test_pages(spark):
    page = "<html><head><title>t</title></head><body><header>H</header><div class='cookie-notice'>C</div>{}<footer>F</footer></body></html>"
    rows = [
        (1, "http://h.org/a/1", page.format("<article><h1>A &amp; b</h1><p>one <b>t</b>wo<p>three<br>four<ul class=share><li>x</ul></article>")),
        (2, "http://h.org/a/21", page.format("<p>Shared notice</p><p>own text of two</p>")),
        (3, "http://h.org/a/22", page.format("<p>Shared notice</p><p>own text of three</p>")),
        (4, None, page.format("<p>alone</p>")), (5, "http://h.org/b/9", None), (None, "x", ""), (7, "http://z.org/", "<p>copy</p>"), (7, "http://z.org/", "<p>copy</p>"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS text")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in page_text.html_extract(frame).collect())
    texts = [(0, ""), (1, "A & b one two three four"), (2, "own text of two"), (3, "own text of three"), (4, "alone"), (5, ""), (7, "copy"), (7, "copy")]
    assert got == [(i, t, len(t)) for i, t in texts]
    assert page_text.html_extract(frame.limit(0)).count() == 0


def test_article_keeps_its_links_and_marked_sections():
    article = ("<h2><a href=/x>Linked headline</a></h2><p><a href=/y>Linked paragraph</a><ul><li><a href=/z>item</a></ul>"
               "<section id='discussion'><p>one</section><h2 id='related-work'>two</h2><section id='search-algorithm'>three</section>"
               "<div class='no-sidebar'>four</div><div class='content has-sidebar'>five</div><p aria-label='share of votes'>six</p>"
               "<section class='discussion'>seven</section><ul class='share'><li>gone</ul><nav>gone</nav><div class='x Related'>gone</div><p hidden>gone</p>")
    expected = "Linked headline Linked paragraph item one two three four five six seven"
    menu = "<div class='side-menu'>gone</div><p>gone"
    for page in (f"<article>{article}</article>", f"<main id='search' class='has-sidebar'>{article}</main>", f"<div class='page no-sidebar'><article>{article}</article></div>",
                 f"<div class='content has-sidebar'>{article}</div>"):
        assert page_text.main_text(f"<body>{menu}{page}</body>", None) == expected


def test_differences_decide_inside_an_article_too(spark):
    """A menu that neighbours share goes; shared prose and links of one page only stay."""
    page = "<article><h1>T{0}</h1><ul><li><a href='/'>Home</a><li><a href='/n'>All news</a></ul><p>A sentence that both say.</p><p><a href=/x>Source {0}</a></p><p>{1}</p></article>"
    long = "Words of this page only, number {0}, which are many more than those it shares with the page beside it."
    rows = [(i, f"http://h.org/a/{i}", page.format(i, long.format(i))) for i in (1, 2)]
    rows += [(3, "http://z.org/a", page.format(3, long.format(3)))]
    got = {r["page_id"]: r["text"] for r in page_text.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "T{0} {1}A sentence that both say. Source {0} " + long
    assert got == {i: text.format(i, menu) for i, menu in ((1, ""), (2, ""), (3, "Home All news "))}


def test_template_prose_inside_an_article_goes_by_the_differences(spark, monkeypatch):
    """A notice that all neighbours have goes, a sentence of some stays; copies neither hide a page's neighbours nor count as them."""
    page = "<article><h1>T{0}</h1><p>Sign up for our letter.</p>{1}<p>{2}</p></article>"
    own = "Words of this page only, number {0}, which are many more than those it shares with the pages beside it."
    quote = "<p>A sentence that some quote.</p>"
    rows = [(i, f"http://h.org/a/{i}", page.format(i, quote if i < 23 else "", own.format(i))) for i in range(20, 30)]
    rows += [(100 + i, f"http://h.org/a/25?copy={i}", rows[5][2]) for i in range(6)]
    rows += [(i, f"http://few.org/{i}", page.format(i, "", own.format(i))) for i in (1, 2)]
    rows += [(i, f"http://open.org/{i // 3}", f"<p>Sign up for our letter.</p><p>{own.format(i // 3)}") for i in (33, 34, 36)]
    expected = {i: f"T{i} " + ("A sentence that some quote. " if i < 23 else "") + own.format(i) for i in range(20, 30)}
    expected |= {100 + i: expected[25] for i in range(6)} | {i: f"T{i} Sign up for our letter. " + own.format(i) for i in (1, 2)}
    expected |= {i: own.format(i // 3) for i in (33, 34, 36)}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for run in (page_text.RUN, 5):
        monkeypatch.setattr(page_text, "RUN", run)
        assert {r["page_id"]: r["text"] for r in page_text.html_extract(frame).collect()} == expected


def test_template_prose_amid_an_article_goes_by_the_alignment(spark):
    """A notice goes wherever the alignments with all neighbours find it, also behind and before any number of paragraphs."""
    own = "Paragraph {1} of page {0} with words of this page only, which are many more than those it shares."
    quote = "A sentence that some quote."
    rows, expected = [], {}
    for i in range(20, 30):
        head, tail = ([own.format(i, j) for j in range(at, at + n)] for at, n in ((0, i % 4), (4, 1 + i % 3)))
        text = [f"T{i}", *head, "Sign up for our letter.", *([quote] if i < 23 else []), *tail]
        rows.append((i, f"http://h.org/a/{i}", "<article><p>" + "</p><p>".join(text) + "</p></article>"))
        expected[i] = " ".join(x for x in text if x != "Sign up for our letter.")
    got = {r["page_id"]: r["text"] for r in page_text.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == expected


def test_many_near_copies_side_by_side_are_compared_with_a_page_beyond_them(spark, monkeypatch):
    """Menus and notices go from near copies too, however many of them stand between a page and the next other one."""
    body = " ".join(f"word{i}" for i in range(60))
    other = "<p>Unmarked notice.</p><p>" + " ".join(f"other{i}" for i in range(60)) + "</p>"
    rows = [(i, f"http://h.org/a/{i}", f"<p>Unmarked notice.</p><p>{body}</p><p>version {i}</p>") for i in range(20, 50)]
    expected = {i: f"{body} version {i}" for i, _, _ in rows}
    rows += [(i, f"http://{host}.org/a/60", other) for i, host in ((60, "h"), (61, "g"), (62, "i"))]
    rows += [(i, f"http://only.org/a/{i}", f"<p>Unmarked notice.</p><p>{body}</p><p>version {i}</p>") for i in range(70, 82)]
    alone = other.replace("<p>", "").replace("</p>", " ").strip()
    expected |= {60: alone.replace("Unmarked notice. ", ""), 61: alone, 62: alone} | {i: f"Unmarked notice. {body} version {i}" for i in range(70, 82)}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for run in (page_text.RUN, 5):
        monkeypatch.setattr(page_text, "RUN", run)
        assert {r["page_id"]: r["text"] for r in page_text.html_extract(frame).collect()} == expected


def test_page_differences_equal_those_of_all_pairs(spark, monkeypatch):
    """The pages beside a page in the order of host and path, taken from a sorted list."""
    rng = random.Random(5)
    rows = []
    for i in range(150):
        text = "".join(f"<p>line {rng.randrange(12)}" for _ in range(rng.randrange(1, 9)))
        rows.append((i, f"http://h{rng.randrange(3)}.org/{rng.randrange(4)}/{i}", f"<p>own {i}{text}"))
    pages = sorted((url[7:12], url[12:], page_text._codes(page), i) for i, url, page in rows)
    expected = {}
    for k, (host, path, codes, i) in enumerate(pages):
        beside = [pages[j] for n in range(1, page_text.NEIGHBOURS + 1) for j in (k - n, k + n) if 0 <= j < len(pages) and pages[j][0] == host]
        shared, _ = page_text.differences(path, codes, [(p, c) for _, p, c, _ in beside])
        expected[i] = " ".join(t for j, (t, _, _) in enumerate(page_text.lines(rows[i][2])) if j not in shared)
    monkeypatch.setattr(page_text, "RUN", 7)
    got = {r["page_id"]: r["text"] for r in page_text.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == expected and any(got[i] != rows[i][2].replace("<p>", " ").strip() for i in got)


def test_comments_and_notices_inside_an_article_go():
    gone = ("<section class='comments'><p>gone</section>", "<div id='comments' class='comments-area'>gone</div>", "<section id=comments>gone</section>",
            "<div class='cookie-notice'>gone</div>", "<div class='ad-banner'>gone</div>", "<div id='sidebar'>gone</div>", "<div class='sidebar-widget'>gone</div>",
            "<section class='related-posts'>gone</section>", "<div id='respond'>gone</div>", "<div class='share-buttons'>gone</div>", "<div class='site-footer'>gone</div>")
    for part in gone:
        for page in ("<article><p>one</p>{}<p>two</p></article>", "<main>one{}<p>two</p></main>", "<div class='content'><p>one</p>{}<p>two</p></div>"):
            assert page_text.main_text(page.format(part), None) == "one two", part
    for kept in ("<h2 id='comments'>kept</h2>", "<section id='related-work'>kept</section>", "<div class='no-sidebar'>kept</div>", "<section id='discussion'>kept</section>"):
        assert page_text.main_text(f"<article><p>one</p>{kept}<p>two</p></article>", None) == "one kept two", kept


def test_pages_with_long_lower_case_and_broken_markup():
    page = "<article><p>Visit İstanbul</p><SCRIPT>x()</Script><p>rest</p></article><p>more"
    assert page_text.main_text(page, None) == "Visit İstanbul rest"
    import time

    start = time.process_time()
    for n in (0, 3):
        assert page_text.main_text("<article><p>one</p></article>" * n + "<a 'x " * 150_000, None).startswith("one" if n else "<a 'x")
    assert page_text.main_text("<div><b>" * 100_000 + "deep" + "</i>" * 100_000, None) == "deep"
    assert page_text.main_text("<p>a</p>b <!-- open", None) == "a b" and page_text.main_text("<p>a</p>b <! open", None) == "a b"
    # linear: far below the minutes that a search from every sign to the end would take
    assert time.process_time() - start < 20


def test_common_lines():
    assert page_text.shared_lines([1, 2, 3, 4, 5], [9, 2, 4, 7, 5]) == [1, 3, 4]


def test_bpe(docs, real):
    import public_tokenizers as public
    import tiktoken

    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for table in (docs, real):
        for r in bpe.byte_bpe(table, path, public.PATTERN, keep=["text"], ids=True).collect():
            assert r["ids"] == theirs.encode_ordinary(r["text"] or "")
            assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    ours, rng = bpe.model(open(path, "rb").read(), public.PATTERN), random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice(rng.choice(["ab", " the", "\x00é漢🙂", " \n\t", "0123", "aA!?"])) for _ in range(rng.randint(0, 50)))
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text)


def test_bpe_columns_take_the_place_of_equal_names(docs):
    import public_tokenizers

    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    clash = docs.select("*").selectExpr("*", "'old' AS N_tokens", "'old' AS ids", "'old' AS ids_sha256")
    out = bpe.byte_bpe(clash, *where, ids=True)
    assert out.columns == [*docs.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert all(r["n_tokens"] == len(r["ids"]) for r in out.collect())


def test_toxicity(spark, docs):
    """Held-out rows of a small corpus in which two words are toxic."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{rng.randint(0, 300)}" for _ in range(40)]
        if i % 4 == 0:
            words[rng.randint(0, 39)] = rng.choice(["vilest", "scummy"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = [r for r in toxicity.toxicity(table, label).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in out)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in out]) >= 0.95
    odd = toxicity.toxicity(docs, label.limit(0)).collect()
    assert len(odd) == len(brute.ROWS) and {r["score"] for r in odd} == {0.5}


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "What does the quick brown fox jump over today? It jumps over the lazy dog by noon."),
                                   (2, None), (3, ""), (4, "w10 w11 w12 w13 w14 w15 w16 w17 w18 w19 w20 w21")], "item_id long, text string")
    leak = spark.createDataFrame([(90, brute.SENTENCE * 20 + "WHAT does the quick brown fox jump over today? it jumps over the lazy dog by noon."),
                                  (91, "the quick brown fox and a lazy dog met at noon today by the river")], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(leak)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, items).collect()}
    assert got == {(90, 1), (8, 4), (9, 4)}
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


def test_decontamination_finds_every_item_that_scores(spark, real):
    """Pruned search against scoring every passage with every unit."""
    index = decontaminate.shards(spark.read.parquet(f"{SF}/benchmark.parquet"))[0]
    for r in real.limit(60).collect():
        words, expected = decontaminate.normal_words(r["text"]), {}
        for p in range(0, len(words) + 1, decontaminate.STRIDE):
            passage = set(words[p:p + decontaminate.PASSAGE])
            for b, block in enumerate(index.postings):
                scores = [0.0] * decontaminate.BLOCK
                for w in passage:
                    for u, x in block.get(index.terms.get(w, -1), ()):
                        scores[u] += x
                for u, x in enumerate(scores):
                    if x >= decontaminate.THRESHOLD:
                        item = index.owner[b * decontaminate.BLOCK + u]
                        expected[item] = max(expected.get(item, 0), x)
        assert {i: round(x, 9) for i, x in index.search(words)} == {i: round(x, 9) for i, x in expected.items()}


def test_decontamination_equals_shingle_overlap(spark, real):
    """Against all pairs of documents and items, with questions and scattered items planted without the rest."""
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect() if r["text"]]
    items.append((5000, "Name the river of the old mill? " + " ".join(f"answer{i}" for i in range(40)) + "."))
    items.append((5001, " ".join(f"q{i}" for i in range(70)) + "? " + " ".join(f"a{i}" for i in range(100)) + "."))
    texts = [r["text"] for r in real.limit(60).collect()]
    filler = " ".join(f"filler{i}" for i in range(150))
    for _, text in items:
        question, answer = decontaminate.question_and_answer(text)
        texts += [f"{filler} {question} {filler}", f"{filler} {answer}"]
        w = text.split()
        texts.append(f" {filler} ".join(" ".join(w[i:i + 30]) for i in range(0, len(w), 30)))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected, parts = set(), {i: [decontaminate.grams(decontaminate.normal_words(x)) for x in decontaminate.question_and_answer(t)] for i, t in items}
    for d, text in enumerate(texts):
        words = decontaminate.normal_words(text)
        held = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, 6)}
        for i, (q, a) in parts.items():
            hit_q, hit_a = (sum(g in held[len(g)] for g in x) for x in (q, a))
            if q and hit_q / len(q) >= decontaminate.OVERLAP or q | a and (hit_q + hit_a) / (len(q) + len(a)) >= decontaminate.OVERLAP:
                expected.add((d, i))
    got = decontaminate.contaminated(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)
    assert any(r["score"] < decontaminate.THRESHOLD for r in got if r["item_id"] == 5000)


def test_lm_scores(spark, docs):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * 30) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text").where("doc_id IS NULL OR doc_id < 4").selectExpr("doc_id + 100 AS doc_id", "text"))
    target = spark.createDataFrame([(i,) for i in (1, 3, 5, 7, None)], "doc_id long")
    out = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(table, target).collect()}
    assert out[9]["score"] < 0 < out[8]["score"] and out[9]["n_tokens"] == 90
    assert out[101]["n_tokens"] == 0 and out[101]["score"] == 0
    assert lmscore.cross_entropy_difference(docs.limit(0), target).count() == 0


def test_lm_scores_use_every_word_and_bigram(spark, monkeypatch):
    """Against plain counting, in a corpus so large that a share of its tokens would cut rare words and bigrams."""
    filler = " ".join(["a b"] * 150_000)
    rows = [(1, filler), (2, filler), (3, "rare one here"), (4, "rare two here"), (4, "rare two here"), (5, "Two here a"), (None, None)]
    table, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(3,), (4,)], "doc_id long")
    pairs, words, texts = (([Counter(), Counter()]) for _ in range(3))
    for i, text in rows:
        w, own = brute.words((text or "").lower()), i in (3, 4)
        words[own].update(w)
        pairs[own].update(zip([None, *w], w, strict=False))
        texts[own][None] += bool(w)
    size = len(set(words[0]) | set(words[1]))

    def loss(own, context, word):
        unigram = (words[own][word] + 1) / (sum(words[own].values()) + size + 1)
        seen = (words[own] | texts[own])[context]
        return -np.log(lmscore.BIGRAM * pairs[own][context, word] / max(1, seen) + (1 - lmscore.BIGRAM) * unigram)

    for hot in (lmscore.HOT, 1000):  # the second deals the frequent bigrams over several tasks
        monkeypatch.setattr(lmscore, "HOT", hot)
        out = [r for r in lmscore.cross_entropy_difference(table, target).collect() if r["n_tokens"] == 3]
        assert sorted(r["doc_id"] for r in out) == [3, 4, 4, 5]
        for r in out:
            w = brute.words(dict(rows)[r["doc_id"]].lower())
            means = [np.mean([loss(own, *p) for p in zip([None, *w], w, strict=False)]) for own in (1, 0)]
            assert np.allclose([r["target_loss"], r["background_loss"], r["score"]], [*means, means[0] - means[1]])


def test_lm_scores_leave_little_on_disk(spark, real, monkeypatch):
    """Shuffles and scratch tables together stay below four times the input, as the check tool asks."""
    from pathlib import Path

    def used(*folders):
        return sum(f.stat().st_size for d in folders for f in [Path(d), *Path(d).rglob("*")] if f.is_file())

    folders = [*map(str, spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()), spark.conf.get("spark.checkpoint.dir")]
    before = used(*folders)
    target = real.select("doc_id").where("doc_id % 2 = 0")
    one = sorted(tuple(r) for r in lmscore.cross_entropy_difference(real, target).collect())
    assert used(*folders) - before < 4 * used(f"{SF}/documents.parquet")
    monkeypatch.setattr(lmscore, "HOT", 5_000)  # blocks that need each other's counts
    many = sorted(tuple(r) for r in lmscore.cross_entropy_difference(real, target).collect())
    assert [r[:2] for r in one] == [r[:2] for r in many] and np.allclose([r[2:] for r in one], [r[2:] for r in many])


def test_pipeline_keeps_columns(spark, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns[:len(source.columns)] == source.columns
    assert 0 < out.count() < source.count() and len(corpus_pipeline.STAGES) == 5
