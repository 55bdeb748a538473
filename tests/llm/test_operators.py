"""Each operator against brute force on small tables: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import components, fingerprints, html_extraction, jaccard_join, line_dedup, mixing, nearest, piece_sampling, shared, sharding, shingles, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, k=40):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, k, n))


def rows():
    base = words(1, 60)
    texts = ["", None, "one", "The cat sat on the mat, and the dog is on a log in the old town of the hill.", base, base, base.replace("w1 ", "zz ", 1), "long " * 5000, "\n\n", "a\nb\nc", "😀 é ß <|endoftext|> x", words(2, 200)]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    clash = ("shard", "slot", "score", "size", "row", "class", "key", "rate", "spots", "bucket", "line_no", "text_a")
    frame = spark.createDataFrame(rows() + [rows()[4]], SCHEMA)
    return frame.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def with_null_id(spark, docs):
    return docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("no id here at all")))


# --- token counts ---------------------------------------------------------------------------------------------------


def test_token_counts_match_the_library(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(shared.tokenizer_file("byte_bpe_50k.json"))
    got = token_counts.count_tokens(with_null_id(spark, docs), shared.tokenizer_file("byte_bpe_50k.json"), batch_bytes=64).collect()
    want = {r[0]: (len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows()}
    assert len(got) == len(rows()) + 2
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_tokens) == want[r.doc_id]
            assert r.over_limit == (r.n_tokens > 512)
    assert token_counts.count_tokens(empty, shared.tokenizer_file("byte_bpe_50k.json")).collect() == []


def test_safe_parts_keep_the_text():
    text = "ab  cd ef\tgh " * 400
    parts = token_counts.safe_parts(text, 50)
    assert "".join(parts) == text and len(parts) > 10
    assert all(p[0] == " " and not p[1].isspace() for p in parts[1:])


# --- sharding -------------------------------------------------------------------------------------------------------


def test_sharding_places_every_row_once(spark, docs, empty):
    many = spark.range(103).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 != 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("text"), F.lit("x").alias("slot"))
    found = sharding.digest(sharding.shuffle_into_shards(many, 8, bucket_bytes=40)).collect()
    assert sorted(r.doc_id for r in found) == list(range(103))
    per = collections.defaultdict(list)
    for r in found:
        per[r.shard].append(r.slot)
        text = "" if r.doc_id % 10 == 0 else f"t{r.doc_id % 5}"
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text.encode()) and r.law == "rows" and r.grown_shard is None
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    again = sharding.digest(sharding.shuffle_into_shards(many.repartition(7), 8, bucket_bytes=40)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in found} == {(r.doc_id, r.shard, r.slot) for r in again}
    assert [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))] != list(range(103))
    assert sharding.shuffle_into_shards(with_null_id(spark, docs), 3).count() == len(rows()) + 2
    equal = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 2990, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    spread = sharding._numbered(equal, 1).select(F.pmod("_hash", F.lit(20)).alias("bucket")).groupBy("bucket").count().collect()
    assert len(spread) == 20 and max(r["count"] for r in spread) < 250
    placed = sharding.shuffle_into_shards(equal, 8, bucket_bytes=1000).collect()
    assert len({(r.shard, r.slot) for r in placed}) == 3000 and len({r.text for r in placed}) == 11
    assert sharding.shuffle_into_shards(empty, 8).collect() == []


# --- fingerprints ---------------------------------------------------------------------------------------------------


def true_spots(text):
    """Signatures by a walk over the words."""
    found, chain, anchor, anchors = [], [], None, set(fingerprints.ANCHORS)
    tokens = re.findall(r"[^\W_]+", text.lower())

    def plain(run):
        if len(run) == len(tokens) < fingerprints.CHAIN and run:
            return [run]
        return [run[i : i + fingerprints.CHAIN] for i in range(0, len(run) - fingerprints.CHAIN + 1, fingerprints.CHAIN)]

    def flush():
        if anchor is None:
            found.extend(plain(chain))
        elif chain:
            found.append(["@" + anchor, *chain[:3]])
            found.extend(plain(chain[3:]))

    for word in tokens:
        if word in anchors:
            flush()
            anchor, chain = word, []
        else:
            chain.append(word)
    flush()
    made = {" " + " ".join(x) + (" " if len(x) == len(tokens) < fingerprints.CHAIN and x[0][0] != "@" else "") for x in found}
    return {hashlib.md5(x.encode()).hexdigest()[:16] for x in (made or {text} if text else ())}


def test_fingerprints_against_brute_force(spark, docs, empty):
    plain = spark.createDataFrame([r for r in rows()], SCHEMA)
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(plain).collect()}
    texts = [r[1] or "" for r in rows()]
    sets = {i: true_spots(t) for i, t in enumerate(texts)}
    assert got[4].fingerprint == got[5].fingerprint and got[0].fingerprint == ""
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        moved = len(text) // 4
        edited = text[: len(text) - moved] + after[:moved]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == "".join(sorted(sets[i])) and got[i].edited_fingerprint == "".join(sorted(true_spots(edited)))
        for b, near in ((sets[(i + 1) % len(texts)], got[i].near_next), (true_spots(edited), got[i].near_edited)):
            assert near == pytest.approx(len(sets[i] & b) / len(sets[i] | b) if sets[i] | b else 1.0)
    assert got[11].near_edited > 0.3
    assert fingerprints.fingerprint_report(empty).collect() == []
    odd = with_null_id(spark, docs)
    found = fingerprints.fingerprint_report(odd).collect()
    key = lambda x: (-1 if x is None else x)
    by_id = {key(r.doc_id): r for r in found}
    assert sorted(key(r.doc_id) for r in found) == sorted(key(r.doc_id) for r in odd.collect())
    assert by_id[-1].edited_sha256 == hashlib.sha256(b"no id here at").hexdigest()  # 16 code points, 4 of them from the next, empty, text
    assert all(by_id[i].fingerprint == got[i].fingerprint and by_id[i].class_id == got[i].class_id for i in got)
    assert fingerprints.fingerprint_report(plain.limit(1)).count() == 1


def test_spots_are_anchors_with_content_words(spark):
    texts = ["The red-fox of the deep dark cold wood", "one two", "a the", "b1 b2 b3 b4 b5 b6 b7 b8 b9 in x", "?!"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(fingerprints.spots_in(F.col("t")).alias("s")).collect()
    assert [r.s for r in found] == [[" @the red fox", " @the deep dark cold"], [" one two "], [], [" b1 b2 b3 b4 b5 b6 b7 b8", " @in x"], []]


def test_documents_alike_against_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = ["", None]
    for i in range(90):
        w = words(i // 15, 70).split()
        for _ in range(rng.integers(0, 4)):
            w[rng.integers(70)] = str(rng.choice(["the", "of", "new", "old"]))
        texts.append(" ".join(w))
    texts += texts[2:5] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("class_id", "c1", "spots")})
    sets, up = {i: true_spots(t or "") for i, t in enumerate(texts)}, list(range(len(texts)))
    for _ in range(len(texts)):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    up[a] = up[b] = min(up[a], up[b])
        if all(up[a] == up[up[a]] for a in sets):
            break
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(frame).collect()}
    assert {i: r.alike_id for i, r in got.items()} == dict(enumerate(up)) and len(set(up)) < len(texts) - 20
    assert all(r.class_id == min(j for j in sets if sets[j] == sets[i] and (sets[j] or j == i)) for i, r in got.items())


def test_ranges_of_ids_are_of_even_size(spark):
    ids = [*range(2000), 10**15, -(10**12), *[None] * 400]
    frame = spark.createDataFrame([(i, f"text {n} " * 4) for n, i in enumerate(ids)], "doc_id long, text string")
    placed = fingerprints._ranges(frame, 1000, 64).collect()
    sizes = collections.Counter(r["_bucket"] for r in placed)
    assert max(sizes.values()) < 80 and len(placed) == len(ids)
    order = [r["_bucket"] for r in sorted(placed, key=lambda r: (r.doc_id is not None, r.doc_id or 0)) if r.doc_id is not None]
    assert order == sorted(order)
    linked = fingerprints.with_next(frame.where("doc_id is not null"), {}, ["doc_id"], 1000, 64).collect()
    known = sorted(i for i in ids if i is not None)
    assert {r.doc_id: r.next.doc_id for r in linked} == dict(zip(known, known[1:] + known[:1], strict=True))


# --- line dedup -----------------------------------------------------------------------------------------------------


def test_lines_recurring_across_documents_go(spark, docs, empty):
    same = "this line stands in many documents"
    own = ["apples fall from old trees", "nobody came to dinner yesterday", "rain kept us at home", "seven boats left before dawn"]
    texts = [f"{same}\n{w}" for w in own]
    texts += [f"order 12{i} shipped from {c} today" for i, c in enumerate(("rome", "oslo", "bern"))]
    texts += [f"very same words here and there {x} end" for x in ("alpha", "beta", "gamma")]
    texts += [None, "", "short", "short", "short", "only here"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("line_no", F.lit(1))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, keep_first=True).collect()}
    assert got[0] == texts[0]  # the first keeps it
    assert [got[i] for i in (1, 2, 3)] == [t.split("\n")[1] for t in texts[1:4]]
    assert got[7] == texts[7] and got[8] == got[9] == ""  # generalised: one word varies
    assert got[10] is None and got[11] == "" and got[12] == got[13] == "short" and got[15] == "only here"
    none = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert [none[i] for i in range(4)] == own and not any(none[i] for i in range(4, 10))
    assert line_dedup.dedup_lines(empty).collect() == []
    assert line_dedup.dedup_lines(with_null_id(spark, docs)).count() == len(rows()) + 2


def test_long_lines_of_two_documents_go(spark):
    plain = lambda seed, n: words(seed, n, 400).translate(str.maketrans("0123456789", "abcdefghij"))
    passage, own, tail = plain(31, 60), [plain(40 + i, 55) for i in range(4)], plain(50, 40)
    texts = [f"{passage}\n{own[0]}", f"{own[1]}\n{passage}", f"{own[2]} {own[3]}\n{tail} x", f"{own[2]} {own[3]}\n{tail} y", "a short line\nof one", "a short line\nof two"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, keep_first=True).collect()}
    assert got[0] == texts[0] and got[1] == own[1] and got[2] == texts[2] and got[3] == texts[3].split("\n")[1]
    assert got[4] == texts[4] and got[5] == texts[5]
    spared = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, keep_first=True, spare=(5, 80)).collect()}
    assert spared == {**got, 3: texts[3]}  # a near copy as a whole


def test_rare_values_of_a_skewed_field_go(spark):
    values = ["rome"] * 6 + ["oslo", "bern", "rome"]
    texts = [f"the parcel was sent out from {v} to you" for v in values]
    texts += [f"we met in the old {v} of town {w} again" for v, w in zip(["inn"] * 3 + ["pub", "inn", "bar"], ["today"] * 3 + ["once", "late", "twice"], strict=True)]
    texts += ["the parcel was lost", "a parcel was sent out from oslo to you", "we met in the new park of village today once"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, keep_first=True).collect()}
    assert {i for i, t in got.items() if t} == {0, 9, 15, 16, 17}
    assert all(got[i] == texts[i] for i in (0, 9, 15, 16, 17))
    assert {r.doc_id for r in line_dedup.dedup_lines(frame).where("text <> ''").collect()} == {15, 16, 17}


# --- shingles, joins, components ------------------------------------------------------------------------------------


def true_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def true_components(texts, width, percent):
    sets = {i: true_set(t, width) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def copies(seed, groups=12, size=9, n=70):
    rng = np.random.default_rng(seed)
    out = ["", None, "one two", "one two", "ONE  two\t"]
    common = words(999, 25, 1000)
    for g in range(groups):
        base = words(seed * 100 + g, n + g, 4000).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.integers(0, 5)):
                w[rng.integers(0, len(w))] = f"e{rng.integers(0, 4)}"
            out.append(" ".join(w) + (" " + common if rng.random() < 0.5 else ""))
    return dict(enumerate(out))


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2)])
def test_near_duplicates_against_brute_force(spark, width, percent, seed):
    texts = copies(seed)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"class": F.lit("x"), "n": F.lit(1)})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame, width, percent).collect()}
    assert got == true_components(texts, width, percent)


def revisions(seed, families=60, n=50, changed=7):
    """Families of two revisions below 0.8 to each other, two copies of each with one word of their own."""
    rng = np.random.default_rng(seed)
    texts = []
    for f in range(families):
        first = [f"w{f}x{i}" for i in range(n)]
        second = list(first)
        for i in rng.choice(n, changed, replace=False):
            second[i] = f"v{f}x{i}"
        for r, base in enumerate((first, second)):
            for c in range(2):
                copy = list(base)
                copy[rng.integers(n)] = f"own{f}x{r}x{c}"
                texts.append(" ".join(copy))
    return dict(enumerate(texts))


def test_one_large_group_of_near_copies(spark):
    rng = np.random.default_rng(8)
    base, texts = words(77, 60, 4000).split(), {}
    for i in range(500):
        w = list(base)
        for at in rng.choice(60, int(rng.integers(0, 6)), replace=False):
            w[at] = f"r{rng.integers(0, 3)}"  # replaced words are shared, too
        if rng.random() < 0.3:
            w = w[int(rng.integers(0, 12)) :]
        texts[i] = " ".join(w)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for width, percent in ((3, 90), (5, 80), (2, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame, width, percent).collect()}
        assert got == true_components(texts, width, percent)


def test_differences_are_listed_once_for_all_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base, texts, called = words(77, 60, 4000).split(), {}, []
    for i in range(300):
        w = list(base)
        for at in rng.choice(60, int(rng.integers(0, 6)), replace=False):
            w[at] = f"r{rng.integers(0, 3)}"
        texts[i] = " ".join(w[int(rng.integers(0, 12)) :] if rng.random() < 0.3 else w)
    listed = jaccard_join._difference_lists
    monkeypatch.setattr(jaccard_join, "_difference_lists", lambda *a: called.append(1) or listed(*a))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame, 3, 90).collect()}
    assert got == true_components(texts, 3, 90) and len(called) == 1


def test_null_ids_and_repeated_rows(spark):
    texts = copies(6, 5, 6)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    many = frame.union(frame).union(frame.where("doc_id % 2 = 0")).union(frame.select(F.lit(None).cast("long"), "text"))
    truth = true_components(texts, 5, 80)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(many, 5, 80).where("doc_id is not null").collect()}
    assert got == {(i, *t) for i, t in truth.items()}
    nameless = jaccard_join.near_duplicates(frame.select(F.lit(None).cast("long").alias("doc_id"), "text"), 5, 80).where("n_shingles > 0")
    assert {r.component_id for r in nameless.collect()} == {None}
    assert nameless.select("component").distinct().count() == len({t for i, (n, t) in truth.items() if n})


def test_links_inside_a_lone_group(spark):
    texts = revisions(11)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame, 1, 80).collect()}
    assert got == true_components(texts, 1, 80)


def test_one_document_of_each_component_stays(spark, docs, empty):
    texts = copies(3, 4, 5)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    repeated = frame.union(frame.where("doc_id % 3 = 0"))
    kept = sorted(r.doc_id for r in jaccard_join.keep_one(repeated).collect())
    truth = true_components(texts, 5, 80)
    assert [i for i in kept if truth[i][0]] == [i for i in sorted(texts) if truth[i][0] and truth[i][1] == i]
    assert [i for i in kept if not truth[i][0]] == sorted(i for i in [*texts, *[j for j in texts if j % 3 == 0]] if not truth[i][0])
    assert jaccard_join.keep_one(empty).collect() == []
    assert jaccard_join.near_duplicates(with_null_id(spark, docs)).count() == len(rows()) + 2


def test_shingle_hashes_stand_for_words():
    texts = [t for t in copies(5).values() if t] + ["A b\x0bC d", "a\tB c  D", "x" * 100]
    hashed = shingles.shingle_sets([t.encode() for t in texts])
    seen = {}
    for t, h in zip(texts, hashed, strict=True):
        assert len(h) == len(true_set(t, 3))
        assert seen.setdefault(true_set(t, 3), tuple(h)) == tuple(h)


def test_components_of_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# --- HTML -----------------------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a><p>Site name</p></header>
<div id="cookie-notice">We use cookies. Accept them please.</div><div class="layout"><div class="sidebar"><p>Buy now, this is a long sidebar text that goes on. Yes it does.</p></div>
<div class="content"><h2>Head &amp; line</h2><p>First para with a <a href=x>link</a> in it.<br>More   text.</p><div class="ad-slot">Cheap things here. Buy!</div>
<ul><li>One</li><li>Two</li></ul><p>Last.</p><form><label>Mail</label><button>Send it</button></form></div>
<section class="comments"><h3>Comments</h3><p>Great article! I liked it a lot. Thanks for writing.</p></section></div><footer>(c) 2020</footer><script>if(a<b)x="</p>"</script></body></html>"""


def test_html_keeps_the_article_only(spark):
    want = "Head & line\nFirst para with a link in it. More text.\nOne\nTwo\nLast."
    assert html_extraction.main_text(PAGE) == want
    unclosed = "<nav><ul><li><a href=/a>menu</a></ul></nav><article><h1>Title</h1><p><b>Bold text<br><p>Second &lt;one&gt; here"
    assert html_extraction.main_text(unclosed) == "Title\nBold text\nSecond <one> here"
    assert [html_extraction.main_text(x) for x in (None, "", "<p", "<!-- x", "<script>a")] == [""] * 5
    long = "<article>" + "<p>word word.</p>" * 3000 + "</article>"
    assert html_extraction.main_text(long).count("\n") == 2999
    frame = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html_extraction.extract(frame).orderBy("page_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [(want, len(want))] * 2 + [("", 0)]
    assert html_extraction.extract(frame.limit(0)).collect() == []


def test_min_cut_is_minimal():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = 7
        odds = rng.normal(0, rng.choice([0.3, 1.0, 3.0]), n).tolist()
        caps = [{} for _ in range(n)]
        for i, j in [(i, i + 1) for i in range(n - 1)] + [(0, 3), (3, 6), (1, 5)]:
            caps[i][j] = caps[j][i] = float(rng.random() * 2)

        def cost(side):
            return sum(max(0.0, x) for x, s in zip(odds, side, strict=True) if not s) + sum(max(0.0, -x) for x, s in zip(odds, side, strict=True) if s) + sum(c for i in range(n) for j, c in caps[i].items() if i < j and side[i] != side[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_extraction.minimum_cut(odds, [dict(c) for c in caps])) == pytest.approx(best)


def test_the_cut_corrects_the_classifier():
    prose = "<p>{} A sentence that goes on for a while, and another one that follows it closely. It ends here.</p>"
    page = "<div class=x><div><a href=/a>Home and more</a></div><div>Us today</div><div><a href=/b>Other things here</a></div></div>"
    page += f"<div>{prose.format('One.')}<p><a href=/c>Linked words of four</a></p>{prose.format('Two.')}</div>"
    blocks = html_extraction.blocks_of(page)
    alone = [html_extraction.log_odds(b, (0.1, 1.0, -2.0, 0.3, 0.0)) > 0 for b in blocks]
    cut = html_extraction.content_blocks(blocks, (0.1, 1.0, -2.0, 0.3, 0.0), 2.0)
    assert alone == [False, True, False, True, False, True]
    assert cut == [False, False, False, True, True, True]


def test_costs_are_fitted_to_what_elements_say(spark):
    page = "<nav>" + "<li><a href=x>go on</a></li>" * 5 + "</nav><article><p>" + "some words of text. " * 9 + "</p><p>more of them, without an end</p></article><footer>short words of law</footer>"
    weights, edge = html_extraction.fit([page] * 20)
    assert weights[2] < html_extraction.FIRST_WEIGHTS[2] and edge in html_extraction.EDGES
    bare = re.sub("article|nav|footer", "div", page)
    assert html_extraction.main_text(bare, weights, edge).startswith("some words of text")
    assert html_extraction.fit([]) == html_extraction.fit(["<p>x</p>"]) == (html_extraction.FIRST_WEIGHTS, html_extraction.FIRST_EDGE)
    frame = spark.createDataFrame([(1, "u", page, "x", "y")], "page_id long, url string, html string, text string, n_chars string")
    assert html_extraction.extract(frame).columns == ["page_id", "url", "text", "n_chars"]


def test_html_of_many_blocks_and_great_depth():
    import time

    began = time.time()
    many = "<div>" + "".join(f"<p>{'word ' * (i % 9)}{'End.' if i % 3 else ''} x</p><ul><li><a href=x>go</a></li></ul>" for i in range(20000))
    assert html_extraction.main_text(many, (0.5, 1.0, -4.0, 0.5, 0.0), 1.0)
    deep = "<div>" * 20000 + "<p>One sentence of text stands here, all alone.</b></p>" * 2000
    assert html_extraction.main_text(deep).count("\n") == 1999
    assert time.time() - began < 20


# --- sampling of segmentations --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return piece_sampling.load_pieces(shared.tokenizer_file("piece_bpe_32k.model"))


def test_a_kept_lattice_changes_no_sample(pieces):
    texts = [["so much depends", "", "upon"], [], [""], ["upon a red  wheel\nbarrow", "é😀 depends"], ["so much", "wheel wheel"]]
    kept = piece_sampling.Lattice(pieces)
    for some in texts:
        keys = np.arange(len(some))
        alone, beside = piece_sampling.sample_rows(pieces, some, keys, 3), piece_sampling.sample_rows(pieces, some, keys, 3, kept)
        assert [[x[0].tolist() for x in row] for row in alone] == [[x[0].tolist() for x in row] for row in beside]
        assert np.allclose([x[1:] for row in alone for x in row], [x[1:] for row in beside for x in row])
    assert len(kept.numbers) == len(kept.start) and len(kept.first) == kept.nodes + 1
    kept.clear()
    again = piece_sampling.sample_rows(pieces, texts[3], np.arange(2), 3, kept)
    assert [[x[0].tolist() for x in row] for row in again] == [[x[0].tolist() for x in row] for row in piece_sampling.sample_rows(pieces, texts[3], np.arange(2), 3)]


def test_samples_follow_the_lattice_without_replacement(pieces):
    by_bytes = {b: i for i, b in enumerate(pieces.bytes_of) if b and i > 258}

    def every(text):
        if not text:
            return [((), 0.0)]
        return [((by_bytes[text[:n].encode()], *r), pieces.logp[by_bytes[text[:n].encode()]] + lp) for n in range(1, len(text) + 1) if text[:n].encode() in by_bytes for r, lp in every(text[n:])]

    paths = every(" on an")
    total = np.logaddexp.reduce([lp for _, lp in paths])
    p = {s: math.exp(lp - total) for s, lp in paths}
    n = 6000
    found = piece_sampling.sample_rows(pieces, ["on an"] * n, np.arange(n) * 31 + 7, 2)
    first, second = collections.Counter(tuple(r[0][0]) for r in found), collections.Counter(tuple(r[1][0]) for r in found)
    weight = collections.Counter()
    for r in found:
        assert tuple(r[0][0]) != tuple(r[1][0]) and r[0][2] >= r[1][2]
        for ids, logp, _, inclusion in r:
            assert math.exp(logp) == pytest.approx(p[tuple(ids)])
            weight[tuple(ids)] += math.exp(logp - inclusion) / n
    for s in sorted(p, key=p.get)[-4:]:
        next_p = sum(p[a] * p[s] / (1 - p[a]) for a in p if a != s)
        assert abs(first[s] / n - p[s]) < 4 * math.sqrt(p[s] / n) + 1e-3
        assert abs(second[s] / n - next_p) < 4 * math.sqrt(next_p / n) + 1e-3
        assert weight[s] == pytest.approx(p[s], abs=0.02)  # inclusion scores make sums over samples unbiased


def test_segmentations_decode_and_do_not_depend_on_company(spark, docs, empty, pieces):
    path = shared.tokenizer_file("piece_bpe_32k.model")
    got = piece_sampling.sample_encode(with_null_id(spark, docs), path, k=3).collect()
    assert all(r.decoded_ok and r.n_pieces == len(r.ids) for r in got)
    per = collections.defaultdict(list)
    for r in got:
        per[r.doc_id].append(tuple(r.ids))
    assert per[0] == [()] and len(per[11]) == 3 and len(set(per[11])) == 3
    assert len(per[4]) == 6 and len(set(per[4])) == 3  # the repeated row has the same samples
    alone = piece_sampling.sample_encode(docs.where("doc_id = 11"), path, k=3).orderBy("sample").collect()
    assert [tuple(r.ids) for r in alone] == [tuple(r.ids) for r in sorted((r for r in got if r.doc_id == 11), key=lambda r: r.sample)]
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert library.decode(list(alone[0].ids)) == rows()[11][1]
    assert piece_sampling.sample_encode(empty, path).collect() == []


# --- toxicity -------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows_and_misspellings(spark, empty):
    rng = np.random.default_rng(3)
    syllables = [a + b for a in "bcdfghklmnprst" for b in "aeiou"]

    def clean(n):
        return " ".join("".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(n))

    data = []
    for i in range(700):
        text, toxic = clean(rng.integers(5, 120)), int(i % 6 == 0)
        if toxic:
            w = text.split()
            for x in rng.choice(["zorgwitz", "quaxxel", "vlimprox"], 2, replace=False):
                w.insert(rng.integers(0, len(w)), x + str(rng.choice(["", "en", "s"])))
            text = " ".join(w)
        data.append((i, text, toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(9000, None), (9001, ""), (9002, clean(4000)), (9003, clean(30) + " quaxxle")], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, x) for i, _, x in data] + [(1, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [(i, x) for i, _, x in data if got[i].held_out]
    assert {i for i, _ in held} == {i for i, _, _ in data if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum((got[i].score >= 0.5) == bool(x) for i, x in held)
    assert right / len(held) > 0.95
    assert got[9000].score == got[9001].score and got[9002].predicted == 0
    assert got[9003].score > got[9001].score  # a misspelling never seen
    assert toxicity.score_documents(empty, labels).collect() == []
    one_kind = toxicity.score_documents(docs, labels.where("toxic = 0")).select("score").distinct().collect()
    assert len(one_kind) == 1 and one_kind[0].score < 0.01


def test_training_rows_pass_over_what_does_not_fit(spark):
    ids = list(range(40))
    frame = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    first = toxicity.training_rows(frame, labels)[0]
    giant = int(first[0].split()[1])
    longer = frame.where(F.col("doc_id") != giant).union(spark.createDataFrame([(giant, "x" * 2000), (giant, "small")], frame.schema))
    got, marks = toxicity.training_rows(longer, labels, max_chars=1000)
    assert got == ["small", *first[1:]] and len(marks) == len(got)
    middle = frame.where(F.col("doc_id") != giant).union(spark.createDataFrame([(giant, "x" * 95)], frame.schema))
    assert len(toxicity.training_rows(middle, labels, max_chars=100)[0]) == 1


def test_long_and_equal_texts_score_alike():
    table = np.random.default_rng(0).normal(0, 1, toxicity.BUCKETS).astype(np.float32)
    long = words(5, 30000, 20000)
    alone = toxicity.score_texts(table, 0.1, [long])
    beside = toxicity.score_texts(table, 0.1, ["x y z", long, long])
    assert alone[0] == beside[1] == beside[2]


# --- mixing ---------------------------------------------------------------------------------------------------------


def test_rates_meet_the_targets(spark, docs, empty):
    rng = np.random.default_rng(1)
    data = [(i, " ".join(rng.choice(["red", "blue", "mix"] if i % 3 else ["green", "grey", "mix"], rng.integers(1, 80)))) for i in range(300)] + [(300, None), (301, "")]
    frame = spark.createDataFrame(data, "doc_id long, text string").withColumn("rate", F.lit("x"))
    labelled = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(0, 300, 2)] + [(5000, "a"), (None, "b"), (1, None)], "doc_id long, domain string")
    found = mixing.rates(frame, labelled, {"a": 0.3, "b": 0.7}).collect()
    assert len(found) == 302 and all(r.rate >= 0 and sum(r.posterior) == pytest.approx(1) for r in found)
    total = sum(r.n_tokens for r in found)
    for i, share in enumerate((0.3, 0.7)):
        assert sum(r.rate * r.n_tokens * r.posterior[i] for r in found) == pytest.approx(share * total, rel=1e-4)
    assert all((r.posterior[0] > 0.5) == bool(r.doc_id % 3) for r in found if r.n_tokens > 10)
    grown = mixing.mix(frame, labelled, {"a": 0.3, "b": 0.7}, budget="grow")
    counts = collections.Counter(r.doc_id for r in grown.collect())
    assert set(counts) == set(range(302)) and grown.columns == frame.columns
    assert mixing.rates(empty, labelled, {"a": 1.0}).collect() == []
    odd = with_null_id(spark, docs)
    kept = collections.Counter((r.doc_id, r.text) for r in mixing.mix(odd, labelled, {"a": 0.5, "b": 0.5}, budget="grow").collect())
    assert all(kept[key] >= n for key, n in collections.Counter((r.doc_id, r.text) for r in odd.collect()).items())
    assert {r.rows for r in mixing.rates(odd, labelled, {"a": 0.5, "b": 0.5}).collect()} == {1, 2}


def test_posteriors_are_those_of_the_counts(spark):
    texts = ["red red blue", "blue green", "green green grey", "red grey", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "doc_id long, domain string")
    got = {r.doc_id: r for r in mixing.posteriors(frame, *mixing.fit_classifier(frame, labelled, ["a", "b"])).collect()}
    counts = {"a": collections.Counter("red red blue blue green".split()), "b": collections.Counter("green green grey".split())}
    prior = {"a": math.log(2.5 / 4), "b": math.log(1.5 / 4)}
    for i, text in enumerate(texts):
        found = (text or "").split()
        logits = [prior[d] + sum(math.log((counts[d][w] + 0.5) / (sum(counts[d].values()) + 0.5 * 4096)) for w in found) for d in "ab"]
        weights = np.exp(np.array(logits) - max(logits))
        assert got[i].n_tokens == len(found) and got[i].posterior == pytest.approx((weights / weights.sum()).tolist())


# --- nearest neighbours ---------------------------------------------------------------------------------------------


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (400, 16)).astype(np.float32)
    x[100:160] = x[100]  # many equal vectors
    data = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    bad = [(1000, None, 0), (1020, [0.0] * 16, 0), (1040, [float("nan")] * 16, 0), (1060, [1.0, None] * 8, 0), (None, [1.0] * 16, 0), (1100, [], 0), (1120, [float("inf")] * 16, 0)]
    frame = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x"))
    got = collections.defaultdict(list)
    for r in nearest.nearest(frame).collect():
        got[r.query_id].append(r)
    x = x.astype(np.float64)
    hits = 0
    for q in range(0, 400, 20):
        found = sorted(got.pop(q), key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21)) and all(r.vec_id != q for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        assert all(r.score == pytest.approx(float(x[q] @ x[r.vec_id]), abs=1e-12) for r in found)
        s = x @ x[q]
        s[q] = -np.inf
        want = set(np.lexsort((np.arange(400), -np.round(s, 10)))[:20].tolist())
        hits += len(want & {r.vec_id for r in found})
    assert hits >= 0.95 * 400 and not got
    few = nearest.nearest(frame.where("vec_id < 3"), every=1).collect()
    assert len(few) == 6
    assert nearest.nearest(frame.limit(0)).collect() == []


def test_nearest_with_repeated_ids_lengths_and_large_numbers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (60, 8))
    x[50] *= 1e200
    data = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(20, [float(v) for v in rng.normal(0, 1, 8)]), (7, [float(v) for v in x[7]])]
    data += [(100 + i, [float(i + 1), 1.0, 2.0]) for i in range(4)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = nearest.nearest(frame, k=5).collect()
    rows = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.same, r.rank)):
        rows[r.query_id, r.same].append((r.rank, r.vec_id, r.score))
    assert sorted(q for q, _ in rows) == [0, 20, 20, 40, 100]
    wanted = []
    for at, (q, v) in enumerate(data):
        if q % 20 == 0:
            others = [(float(np.dot(v, w)), i) for n, (i, w) in enumerate(data) if n != at and len(w) == len(v)]
            wanted.append([i for _, i in sorted(others, key=lambda o: (-round(o[0], 9), o[1]))[:5]])
    assert sorted([i for _, i, _ in v] for v in rows.values()) == sorted(wanted)


def test_graph_crosses_its_first_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 200)
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1200, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest.nearest(frame, degree=24, beam=48).collect()
    hits = 0
    for q in range(0, 1200, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits / (60 * 20) > 0.9
