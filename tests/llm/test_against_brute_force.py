"""Operators that SQL cannot state, against plain implementations."""

import collections
import hashlib
import math
import os
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
import sentencepiece
from conftest import LOWER, prose, words
from pyspark.sql import functions as F

from barloom.llm import common, fingerprints, html, langid, neardup, ngram, token_counts
from barloom.llm import sentencepiece as pieces
from barloom.llm.common import Words, read, text_bytes

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(read(spark, SF_DIR, "documents").select("doc_id", "text").collect())


# --- op2


@pytest.fixture(scope="module")
def model():
    return pieces.Model(*pieces.read_model(pieces.MODEL))


def best_score(model, scores, text):
    """Plain dynamic programme over characters."""
    text = model.normalise(text)
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 48), end):
            piece = text[start:end]
            if piece in scores:
                best[end] = max(best[end], best[start] + scores[piece])
            elif end == start + 1:
                best[end] = max(best[end], best[start] + model.unknown)
    return best[-1]


TEXTS = ["", " ", "a", "  two  spaces ", "the other", "日本語 text 🙂 mark", "\t\n tabs\r\n", "x" * 300, "éèÿ́ Straße", "oththe and then", prose(5, 40)]


def test_pieces_have_the_best_score(model, docs):
    """Where no character is written in bytes, whose pieces have no score."""
    scores = {t: s for t, s, kind in pieces.read_model(pieces.MODEL)[0] if kind == 1}
    in_bytes = set(model.byte_ids.tolist())
    texts = TEXTS + [t[:150].replace("\n", " ") for _, t in docs[:60]]
    ids, bounds = model.encode(texts)
    compared = 0
    for i, text in enumerate(texts):
        own = ids[bounds[i] : bounds[i + 1]].tolist()
        if not in_bytes & set(own):
            assert sum(model.scores[x] for x in own) == best_score(model, scores, text)
            compared += 1
    assert compared > 60


def test_single_words_as_the_library_ranks_them(model):
    def field(number, value):
        def varint(n):
            out = b""
            while n > 127:
                out, n = out + bytes([n & 127 | 128]), n >> 7
            return out + bytes([n])

        return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value

    with open(pieces.MODEL, "rb") as file:
        data = file.read()
    # the last of repeated fields counts: model type 1 is unigram
    proto = b"".join(field(n, v + field(3, 1) if n == 2 else v) for n, v in pieces._message(data))
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    for word in ["the", "and", "hen", "oththe", "thing", "licence", "über", "niño"]:
        ids, _ = model.encode([word])
        ranked = library.nbest_encode_as_ids(word, 3)
        best = max(sum(model.scores[i] for i in x) for x in ranked)
        assert sum(model.scores[i] for i in ids.tolist()) == best


def test_pieces_round_trip(model, docs):
    texts = TEXTS + [t for _, t in docs]
    ids, bounds = model.encode(texts)
    assert model.decode(ids, bounds) == texts
    assert model.decode(*model.encode(["a ▁ mark"])) == ["a   mark"]
    # a byte that ends no character
    assert model.decode(np.array([model.byte_ids[0xE6]], np.int32), np.array([0, 1])) == ["�"]


def test_double_array_finds_every_word_and_no_other():
    words_ = {x.encode(): i for i, x in enumerate(["a", "ab", "abc", "b", "bé", "ß", "日", "日本"])}
    trie = pieces.DoubleArray(words_)

    def find(text):
        state = np.zeros(1, np.int32)
        for byte in text:
            state = trie.step(state, np.array([byte]))
            if state[0] < 0:
                return -1
        return int(trie.value[state[0]])

    for text, i in words_.items():
        assert find(text) == i
    assert find(b"abcd") == find(b"c") == find(b"") == find("本".encode()) == -1


# --- op3


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div class="menu-12"><ul><li><a href="/">Home page of ours</a></li></ul></div>
<div class="cookie-notice">We use cookies, a lot of them, and this is a long text about them.</div>
<div id="wrap"><div class="post post-{n}"><h2>Title &amp; more {n}</h2><p>First   para with <b>bold</b>&nbsp;text<br>and a break. {long}
<p>Unclosed &lt;second&gt; <span class="ad">BUY</span>para. {long}<script>var x = "</p><p>no";</script></p><ul><li>item one<li>item two</ul>
<form><input name=q><button>Go</button></form><div class="ad">Buy now</div></div>
<div class="sidebar"><p>Popular things here {long}</p></div>
<section id="comments"><article><p>A reader says something {long}</p></article></section></div>
<footer>&copy; 2020</footer></body></html>"""


def test_page_text(spark):
    long = prose(9, 30)
    rows = [(i, f"https://www.Example.com:80/{i}", PAGE.format(n=i, long=long)) for i in range(4)]
    rows += [(10, "https://example.com/x", "<div class=post><p>short"), (11, "http://other.org", f"<td>{long}</td>"), (12, None, "just & text <"), (13, "http://e.org", None), (14, "http://e.org", "")]
    got = {r["page_id"]: r for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(4):
        want = [f"Title & more {i}", f"First para with bold text and a break. {long}", f"Unclosed <second> para. {long}", "item one", "item two"]
        assert got[i]["text"].split("\n") == want
        assert got[i]["n_chars"] == len("\n".join(want))
    assert (got[10]["text"], got[11]["text"], got[12]["text"], got[13]["text"], got[14]["text"]) == ("short", long, "just & text <", "", "")


def test_consensus_wins_over_a_page_of_its_own(spark):
    long, aside = prose(1, 60), prose(2, 200)
    usual = f"<body><div class=a><p>{long}</div><div class=b><p>few words</div>"
    odd = f"<body><div class=a><p>{long}</div><div class=b><p>{aside}</div>"
    rows = [(i, "http://h.org/1", usual) for i in range(5)] + [(9, "http://h.org/2", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for few in (0, 1000):
        assert {r["text"] for r in html.extract_pages(pages, few).collect()} == {long}
    alone = spark.createDataFrame(rows[-1:], pages.schema)
    assert html.extract_pages(alone).first()["text"] == aside


def test_two_templates_on_a_host(spark):
    """The host's path stands on the second template too, but empty or beside the article."""
    usual = "<body><div class=content><p>{}</div>"
    other = "<body><div class=content>{}</div><article class=story><p>{}</article>"
    rows = [(i, "http://h.org/1", usual.format(prose(i, 60))) for i in range(6)]
    rows += [(10, "http://h.org/2", other.format("", prose(20, 60))), (11, "http://h.org/3", other.format("<p>by Jo", prose(21, 60)))]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(6)] == [prose(i, 60) for i in range(6)]
    assert (got[10], got[11]) == (prose(20, 60), prose(21, 60))


def test_pages_without_a_host_share_no_path(spark):
    rows = [(i, None, f"<body><div class=a><p>{prose(i, 60)}</div><div class=b><p>few words</div>") for i in range(5)]
    rows += [(9, "no host", f"<body><div class=a><p>{prose(7, 60)}</div><div class=b><p>{prose(8, 200)}</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html.host_paths(pages).count() == 0
    assert {r["page_id"]: r["text"] for r in html.extract_pages(pages).collect()}[9] == prose(8, 200)


def test_deep_nesting_takes_little_memory():
    import tracemalloc

    page = "<div class=some-long-class-name>" * 100_000 + "the text"
    tracemalloc.start()
    try:
        assert html.parse(page).text([]) == "the text"
        assert tracemalloc.get_traced_memory()[1] < 200e6
    finally:
        tracemalloc.stop()
    unmatched = "<div>" * 20_000 + "</span></section>" * 20_000 + "the text"
    assert html.parse(unmatched).text([]) == "the text"


def test_paths_of_a_host_against_plain_votes(spark):
    rows = [(f"http://{'ab'[i % 2]}.org/{i}", PAGE.format(n=i, long=prose(i, 20 + 10 * (i % 3)))) for i in range(20)]
    rows += [("http://a.org/x", f"<body><main><p>{prose(9, 50)}</main>")]
    want = {}
    for host in ("a.org", "b.org"):
        votes = collections.Counter()
        for url, page in rows:
            if host in url:
                scores = html.parse(page).scores()
                votes.update({p: round(v / max(scores.values()), 6) for p, v in scores.items() if v >= 0.25 * max(scores.values())})
        whole = sum(votes.values())
        want[host] = sorted((p for p, v in votes.items() if v >= 0.05 * whole), key=lambda p: (-round(votes[p], 6), len(p), p))
    got = html.host_paths(spark.createDataFrame(rows, "url string, html string").repartition(3)).collect()
    assert {r["host"]: r["paths"] for r in got} == want


def test_given_pages_give_their_articles(spark):
    pages = read(spark, SF_DIR, "pages")
    got = {r["page_id"]: r["text"] for r in html.op3_host_consensus(spark, SF_DIR).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[row["page_id"]] == "\n".join(x for x in parts if x)


# --- op5


def test_fingerprints_of_edited_texts(spark, docs):
    got = {r["doc_id"]: r for r in fingerprints.op5_bottom_k(spark, SF_DIR).collect()}
    plain = lambda text: fingerprints.encode(fingerprints.sketch(text))
    shingles = lambda t: {t[i : i + 9] for i in range(max(1, len(t) - 8))} if t else set()
    errors = []
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = got[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["fingerprint"], row["edited_fingerprint"]) == (plain(text), plain(edited))
        a, b = shingles(text), shingles(edited)
        errors.append(abs(row["near_edited"] - len(a & b) / len(a | b)))
    assert np.mean(errors) < 0.06 and max(errors) < 0.25


def test_neighbours_across_many_partitions(spark):
    rows = [(i * 37 % 101, f"text number {i * 37 % 101} " * (i % 5)) for i in range(101)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    texts = [t for _, t in sorted(rows)]
    for parts in (1, 3, 40):
        found = fingerprints.with_next(frame, parts).withColumn("part", F.spark_partition_id()).toPandas()
        pairs = set()
        for _, part in found.groupby("part", sort=False):
            texts_, after = part["text"].tolist(), part["_after"].tolist()
            pairs |= {(a, b) for a, b, last in zip(texts_, texts_[1:], after, strict=False) if not last}
        assert pairs == {(a, texts[(i + 1) % 101]) for i, a in enumerate(texts)}


def test_sketches_merge_and_estimate():
    a, b = prose(1, 3000), prose(2, 3000)
    x, y, both = fingerprints.sketch(a + b[:9000]), fingerprints.sketch(b), fingerprints.sketch(a + b)
    assert (fingerprints.merge(fingerprints.sketch(a + b[:3000]), fingerprints.sketch(b[2990:] + ""))[:50] == fingerprints.sketch(a + b)[:50]).mean() > 0.9
    n = len({(a + b)[i : i + 9] for i in range(len(a + b) - 8)})
    assert abs(fingerprints.distinct_shingles(both) / n - 1) < 0.35
    assert fingerprints.containment(y, both) > 0.75 and fingerprints.resemblance(x, x) == 1.0
    assert fingerprints.resemblance(fingerprints.sketch(""), fingerprints.sketch(None)) == 1.0
    assert (fingerprints.decode(fingerprints.encode(x)) == x).all()


# --- op6


def plain_classes(rows):
    """Classes by all pairs that share a shingle."""
    sets, n = {}, 0
    for i, (_, text) in enumerate(rows):
        w = words(text)
        sets[i] = collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else {}
        n += bool(w)
    df = collections.Counter(s for c in sets.values() for s in c)
    idf = {s: 1 + math.log(n / k) for s, k in df.items()}
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    by_text, holders = {}, collections.defaultdict(list)
    for i, (_, text) in enumerate(rows):
        if text is not None:
            parent[find(i)] = find(by_text.setdefault(text, i))
    for i, c in sets.items():
        for s in c:
            holders[s].append(i)
    for pair in {(a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k]}:
        a, b = (sets[x] for x in pair)
        if find(pair[0]) != find(pair[1]):
            both = sum(min(a[s], b[s]) * idf[s] for s in a.keys() & b.keys())
            total = sum(k * idf[s] for c in (a, b) for s, k in c.items())
            if both / (total - both) >= 0.8:
                parent[find(pair[0])] = find(pair[1])
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    return {doc_id: min(own) for own in groups.values() for doc_id in own}


def test_classes_of_the_given_documents(spark, docs):
    got = {r["doc_id"]: r["class_id"] for r in neardup.op6_weighted_sampling(spark, SF_DIR).collect()}
    assert got == plain_classes([tuple(r) for r in docs])


def test_classes_of_a_large_group(spark):
    base, rows = prose(1, 200).split(), []
    for i in range(300):  # copies that differ from each other more than from their source
        own = list(base)
        for j in range(i % 4):
            own[(i * 31 + j * 67) % 200] = f"new{i}x{j}"
        rows.append((1000 - i, " ".join(own)))
    rows += [(2000 + i, prose(50 + i, 100)) for i in range(50)]
    rows += [(3000 + i, " ".join(base[:60]) + " " + prose(200 + i, 100)) for i in range(100)]  # a shared passage
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(frame).collect()}
    want = plain_classes(rows)
    assert got == want
    kept = [r["doc_id"] for r in neardup.without_near_duplicates(frame).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_rare_shingles_have_weights_of_their_own(spark, monkeypatch):
    """All stand in less than a tenth of 100 documents."""
    from barloom.llm import ngram

    monkeypatch.setattr(ngram, "TEXT_BYTES", 4096)  # so that frequencies add up over blocks
    passage, phrases = prose(1, 40), [prose(2, 13), prose(3, 13)]
    # 36 shingles of 6 documents shared, 8 of one not: 0.82 if all weighed the same
    rows = [(i, f"{passage} {prose(100 + i, 4)}") for i in range(6)]
    # 96 of two documents shared, 18 of eight and 8 of one not: 0.79 if all weighed the same
    own = prose(4, 100)
    rows += [(10 + k, f"{own} {phrases[k]}") for k in range(2)]
    rows += [(20 + 7 * k + i, f"{phrases[k]} {prose(200 + 7 * k + i, 60)}") for k in range(2) for i in range(7)]
    rows += [(50 + i, prose(300 + i, 60)) for i in range(100 - len(rows))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(frame).collect()}
    assert got == {i: 10 if i == 11 else i for i, _ in rows} == plain_classes(rows)
    kept = [r["doc_id"] for r in neardup.without_near_duplicates(frame).collect()]  # the pipeline's stage
    assert sorted(kept) == [i for i, _ in rows if i != 11]


def test_document_frequencies_add_up_over_blocks(spark, monkeypatch):
    from barloom.llm import ngram

    monkeypatch.setattr(ngram, "TEXT_BYTES", 2048)
    rows = [(i, f"{prose(i % 7, 30)} {prose(i // 3 + 50, 20)} one") for i in range(90)] + [(90, "one two"), (91, ""), (92, "one two")]
    texts = ngram.blocked(spark.createDataFrame(rows, "node long, text string").repartition(3))
    texts = neardup.stored(texts, "text-blocks")
    assert texts.select("_block").distinct().count() > 5
    signed = neardup._block_signatures(texts, neardup.document_frequencies(texts, 4), 4, 92).collect()
    df = collections.Counter(s for _, t in rows if (w := words(t)) for s in {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))})
    want = {i: sorted(df[s] for s in {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}) for i, t in rows if (w := words(t))}
    assert max(df.values()) < 256
    assert {r["node"]: sorted(r["documents"]) for r in signed} == want


def test_a_block_read_by_several_tasks_has_all_its_frequencies(spark, tmp_path):
    rows = [(i, f"{prose(i % 7, 30)} {prose(i // 3 + 50, 20)}") for i in range(90)]
    texts = spark.createDataFrame(rows, "node long, text string").withColumn("_block", F.lit(5).cast("long"))
    texts.repartition(3).write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    assert len({r[0] for r in texts.select(F.input_file_name()).collect()}) == 3
    counts = neardup.document_frequencies(texts, 4)
    assert counts.groupBy("_block", "bucket").count().where("count > 1").isEmpty()
    signed = neardup._block_signatures(texts, counts, 4, 90).collect()
    df = collections.Counter(s for _, t in rows for s in {tuple(t.split()[j : j + 5]) for j in range(46)})
    assert {r["node"]: sorted(r["documents"]) for r in signed} == {i: sorted(df[tuple(t.split()[j : j + 5])] for j in range(46)) for i, t in rows}


def test_near_duplicates_of_stored_texts_that_are_split(spark, monkeypatch):
    """Stored texts are read by row group: parts of one block, by several tasks."""
    passage, phrases = prose(1, 40), [prose(2, 13), prose(3, 13)]
    own = prose(4, 100)
    # as above: these two are linked by full IDF only
    rows = [(10 + k, f"{own} {phrases[k]}") for k in range(2)]
    rows += [(20 + 7 * k + i, f"{phrases[k]} {prose(200 + 7 * k + i, 60)}") for k in range(2) for i in range(7)]
    rows += [(i, f"{passage} {prose(100 + i, 4)}") for i in range(6)]
    rows += [(50 + i, prose(300 + i, 60)) for i in range(100 - len(rows))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    settings = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    write = common.Scratch.stored
    small = {"parquet.block.size": "1024", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.page.size": "256"}
    monkeypatch.setattr(common.Scratch, "stored", lambda self, df, name, **options: write(self, df, name, **options, **small))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(kept) == sorted(set(plain_classes(rows).values())) == sorted(i for i, _ in rows if i != 11)


def plain_classes_counted_once(rows):
    """Classes by all pairs, where those so far count once in the frequencies, until none grows."""
    sets = {i: collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) for i, (_, t) in enumerate(rows) if (w := words(t))}
    holders = collections.defaultdict(list)
    for i, c in sets.items():
        for s in c:
            holders[s].append(i)
    pairs = {(a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k]}
    by_text = {}
    equal = [by_text.setdefault(t, i) if t is not None else i for i, (_, t) in enumerate(rows)]
    parent, units, steps = list(range(len(rows))), list(range(len(rows))), []

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in enumerate(equal):
        parent[find(i)] = find(j)
    while not steps or len(set(units)) > steps[-1]:
        if steps:
            units = [find(i) for i in range(len(rows))]
        idf = {s: 1 + math.log(len(sets) / len({units[i] for i in own})) for s, own in holders.items()}
        for a, b in pairs:
            if find(a) != find(b):
                x, y = sets[a], sets[b]
                both = sum(min(x[s], y[s]) * idf[s] for s in x.keys() & y.keys())
                if both >= 0.8 * (sum(k * idf[s] for c in (x, y) for s, k in c.items()) - both):
                    parent[find(a)] = find(b)
        steps.append(len({find(i) for i in range(len(rows))}))
    groups = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    return {doc_id: min(own) for own in groups.values() for doc_id in own}, steps


def larger_groups():
    """Groups of copies with up to eight of 400 words changed, of 100 and of 12, and passages that unlike texts share."""
    rows = []
    for first, size in ((0, 100), (1000, 12)):
        base = prose(first + 1, 400).split()
        for i in range(size):
            own = list(base)
            for j in range(8 if i % 33 == 32 else i % 8):
                own[(i * 31 + j * 47) % 400] = f"new{first + i}x{j}"
            rows.append((first + i, " ".join(own)))
        rows += [(first + 500 + i, " ".join(base[:80]) + " " + prose(first + 200 + i, 100)) for i in range(20)]
    return rows + [(5000 + i, prose(5000 + i, 9)) for i in range(4000)]


def test_copies_within_larger_groups(spark, tmp_path, monkeypatch):
    from barloom.llm import ngram

    monkeypatch.setattr(ngram, "TEXT_BYTES", 16384)  # so that classes lie in several blocks
    rows = larger_groups()
    want, steps = plain_classes_counted_once(rows)
    assert len(steps) > 3  # grown and grown again, by frequencies in which grown classes count once
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["class_id"] for r in neardup.op6_weighted_sampling(spark, str(tmp_path)).collect()}
    assert got == want
    by_documents = plain_classes(rows)
    assert len(set(by_documents.values())) > len(set(want.values())) + 10
    # what unlike texts share makes them no copies
    assert all(got[i] == i for i, _ in rows if 500 <= i % 1000 or i >= 5000)


@pytest.mark.parametrize("partitions", [1, 3])
def test_classes_of_texts_without_words(spark, partitions):
    rows = [(1, "---"), (2, "..."), (3, "---"), (4, ""), (5, ""), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in neardup.near_duplicate_classes(frame).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 2), 5: (4, 2), 6: (6, 1)}
    kept = corpus_pipeline.near_duplicates(spark, frame, "").collect()  # the pipeline's stage
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 4, 6]


def test_the_rest_of_a_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    base = prose(1, 200).split()
    texts = [(n, " ".join(base[: 2 * n] + [f"new{n}"] + base[2 * n + 1 :]) if n % 3 == 0 else prose(n + 10, 200)) for n in range(30)]
    docs = spark.createDataFrame(texts, "node long, text string")
    weights = spark.sparkContext.broadcast(neardup.Weights(np.zeros(0, np.uint64), np.zeros(0)))
    signed = neardup._signature_rows(docs, weights)
    members = docs.select(F.lit(0).alias("band"), F.lit(7).cast("long").alias("key"), "node")
    labels = docs.select("node", F.when(F.col("node") == 3, 0).otherwise(F.col("node")).alias("label"))
    links = neardup._rest(members, labels, signed, docs, weights)
    got = {r["node"]: r["label"] for r in neardup._relabelled(labels, links).collect()}
    assert got == {n: 0 if n % 3 == 0 else n for n in range(30)}
    assert links.count() < 60


def test_equal_samples_are_as_many_as_the_similarity():
    weights = neardup.Weights(np.zeros(0, np.uint64), np.zeros(0))
    text = prose(1, 400).split()
    found = []
    for cut in (0, 8, 20, 50):
        other = text[: 400 - cut] + prose(77 + cut, cut).split() + text[:40]
        import pyarrow as pa

        t, h, times = neardup.shingles(Words(*text_bytes(pa.array([" ".join(text + text[:40]), " ".join(other)]))))
        w = weights(h, times)
        sig = neardup.signatures(t, h, w, 2)
        a, b = ((h[t == i], w[t == i]) for i in (0, 1))
        found.append((neardup.similarity(a, b), (sig[0] == sig[1]).mean()))
    assert found[0] == (1.0, 1.0)
    assert all(abs(x - y) < 0.2 for x, y in found)


def test_the_filter_loses_less_than_the_bands():
    """Of pairs at the threshold, before any is verified."""
    p, n = neardup.SIMILARITY, neardup.SAMPLES
    least = math.ceil(neardup.AGREEMENT * n)
    filtered = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(least))
    assert filtered < (1 - p**neardup.ROWS) ** (n // neardup.ROWS)


# --- op7


def test_languages_of_held_out_documents(spark):
    lang = read(spark, SF_DIR, "documents").select("doc_id", "lang")
    rows = langid.op7_byte_network(spark, SF_DIR).join(lang, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    own = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in own) >= 0.95 * len(own)


def test_texts_without_letters(spark):
    docs = spark.createDataFrame([(1, "the cat", "en"), (2, "12 !?", "en"), (3, "", "en"), (4, None, "en"), (5, "日", "ja")], "doc_id long, text string, lang string")
    network = langid.train(docs, F.lit(True))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.drop("lang"), network).collect()}
    assert [got[i] for i in (2, 3, 4)] == ["und"] * 3 and {got[1], got[5]} <= {"en", "ja"}
    unlabelled = langid.predict(docs.drop("lang"), langid.train(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)))
    assert {(r["lang_pred"], r["score"]) for r in unlabelled.collect()} == {("und", 0.0)}


def plain_network(network, window):
    """The softmax over one window, by loops."""
    w = network.weights
    pooled = []
    for width in langid.WIDTHS:
        for f in range(langid.FILTERS):
            answers = []
            for at in range(len(window) - width + 1):
                seen = [x for b in window[at : at + width] for x in w["embedding"][b].tolist()]
                answers.append(sum(x * y for x, y in zip(seen, w[f"filter{width}"][:, f].tolist(), strict=True)))
            pooled.append(max(0.0, max(answers) + float(w[f"bias{width}"][f])))
    sums = [sum(x * y for x, y in zip(pooled, w["out"][:, k].tolist(), strict=True)) + float(w["out_bias"][k]) for k in range(len(network.languages))]
    parts = [math.exp(x - max(sums)) for x in sums]
    return [x / sum(parts) for x in parts]


def test_network_equals_plain_loops_and_its_gradients_the_slopes():
    rng = np.random.default_rng(5)
    network = langid.Network(["a", "b", "c"])
    windows = rng.integers(97, 123, (6, langid.WINDOW)).astype(np.uint8)
    windows[1, 40:] = 0
    for i, got in enumerate(network.predict(windows)):
        assert got.tolist() == pytest.approx(plain_network(network, windows[i]), abs=1e-5)
    labels, weight = np.array([0, 1, 2, 0, 1, 2]), np.ones(6)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    loss = lambda: -np.log(network.predict(windows)[np.arange(6), labels]).mean()
    for name, slope in network._gradients(windows, labels, weight).items():
        held = network.weights[name]
        places = np.argsort(-np.abs(slope).reshape(-1))[:3]  # the steepest
        for place in (np.unravel_index(i, held.shape) for i in places):
            before = held[place]
            held[place] = before + 1e-6
            up = loss()
            held[place] = before - 1e-6
            down = loss()
            held[place] = before
            assert slope[place] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7), name


def test_the_network_rejects_noise_and_keeps_clean_and_mixed_texts(spark):
    # some 750 labelled texts; a network of the 75 at sf0.001 is too unsure to reject half of the noise
    docs = read(spark, os.path.join(os.path.dirname(SF_DIR), "sf0.01"), "documents")
    own = [r["text"] for r in docs.where(langid.held_out(2, 4) & (F.length("text") >= 60)).orderBy("doc_id").select("text").collect()]
    rng = np.random.default_rng(1)
    noise = ["".join(rng.permutation(list(x))) for x in own] + ["".join(map(chr, rng.integers(33, 127, 300))) for _ in own]
    mixed = [f"{a}\n{b}" for a, b in zip(own, own[::-1], strict=True)]
    rows = [(kind, x, None) for kind, texts in (("clean", own), ("mixed", mixed), ("noise", noise)) for x in texts]
    # ids that are held out, so nothing is learned from them
    ids = [i for i in range(10**6, 10**6 + 20 * len(rows)) if zlib.crc32(str(i).encode()) % 4 == 2]
    tried = spark.createDataFrame([(i, *row) for i, row in zip(ids, rows, strict=False)], "doc_id long, kind string, text string, lang string")
    both = docs.select("doc_id", F.lit("learned").alias("kind"), "text", "lang").unionByName(tried)
    kept = collections.Counter(r["kind"] for r in langid.identified(both).collect())
    assert kept["clean"] == kept["mixed"] == len(own)
    assert kept["noise"] <= 0.05 * len(noise)


def test_windows_cover_every_byte():
    import pyarrow as pa

    texts = ["", "abc", "x" * 127 + "end", "y" * 300 + "last"]
    windows, text = langid.windows_of(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        own = windows[text == i]
        assert len(own) == -(-len(t) // langid.WINDOW)
        if len(own):
            assert bytes(own[-1]).rstrip(b"\0").endswith(t.encode()[-3:])


# --- op8


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def test_scores_of_the_given_documents(spark, docs):
    learn = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    c = collections.Counter(t for i, text in docs if learn(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in ngram.op8_elias_fano(spark, SF_DIR).collect()}
    base = score = 0.0
    for i, text in docs:
        own, row = tokens(text), got[i]
        want = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (not learn(i), len(own), sum(c[t] > 0 for t in own), n)
        assert row["base_score"] == pytest.approx(want) and row["score"] < 0
        if row["held_out"]:
            base, score = base + row["base_score"], score + row["score"]
    assert score > base


def plain_scores(train, texts):
    """The same model from dictionaries."""
    c, c2, c3 = (collections.Counter(tuple(own[i : i + k]) for own in map(tokens, train) for i in range(len(own) - k + 1)) for k in (1, 2, 3))
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice)))
    c2, c3 = ({k: x for k, x in m.items() if x >= ngram.LEAST_COUNT} for m in (c2, c3))
    off = ngram.DISCOUNT
    saved2, saved3 = collections.Counter(), collections.Counter()
    for k, x in c2.items():
        saved2[k[:1]] += (x - off) / c[k[:1]]
    for k, x in c3.items():
        saved3[k[:2]] += (x - off) / c2[k[:2]]
    p1 = lambda w: (c[w,] - d) / n if c[w,] else d * v / n
    p2 = lambda u, w: ((c2[u, w] - off) / c[u,] if (u, w) in c2 else 0) + (1 - saved2[u,]) * p1(w)
    p3 = lambda t, u, w: ((c3[t, u, w] - off) / c2[t, u] if (t, u, w) in c3 else 0) + (1 - saved3[t, u]) * p2(u, w)
    out = []
    for text in texts:
        own, total = tokens(text), 0.0
        for i, w in enumerate(own):
            total += math.log10(p3(own[i - 2], own[i - 1], w) if i > 1 else p2(own[0], w) if i else p1(w))
        out.append(total)
    assert sum(p1(w) for (w,) in c) + d * v / n == pytest.approx(1)
    return out


def test_scores_of_the_plain_model(spark):
    train = ["the cat sat on the mat", "The cat sat on a hat", "a dog sat on the mat", "the cat ran"] * 2 + ["once only"]
    held = ["the cat sat on the dog", "unseen words here", "", "the", "a dog sat on the mat", "sat on the"]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = {r["doc_id"]: r["score"] for r in ngram.score_documents(docs, lambda: F.col("learn")).collect()}
    for i, want in enumerate(plain_scores(train, held)):
        assert got[100 + i] == pytest.approx(want, abs=0.01)


def test_n_grams_seen_twice_count_in_a_large_corpus(spark):
    """Among 1.8 million tokens a share of 2e-6 is more than three occurrences."""
    train = [prose(1, 30_000)] * 60 + ["rare pair here", "rare pair here", "a rare bird"]
    held = ["rare pair here", "pair here", "a rare pair", "unseen rare pair"]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = {r["doc_id"]: r["score"] for r in ngram.score_documents(docs, lambda: F.col("learn")).collect()}
    for i, want in enumerate(plain_scores(train, held)):
        assert got[100 + i] == pytest.approx(want, abs=0.01)


def test_rare_words_by_join(spark, docs, monkeypatch):
    usual = {r["doc_id"]: r for r in ngram.op8_elias_fano(spark, SF_DIR).collect()}
    monkeypatch.setattr(ngram, "COUNT_SHARE", 1e-3)
    few = {r["doc_id"]: r for r in ngram.op8_elias_fano(spark, SF_DIR).collect()}
    for i, row in usual.items():
        assert row["n_known"] == few[i]["n_known"]
        assert row["base_score"] == pytest.approx(few[i]["base_score"])


@pytest.mark.parametrize("share", [0.03, 1.0])
def test_numbers_of_rare_words(spark, monkeypatch, share):
    """Words that no task is sent, some and all, have numbers of their own in pairs and triples."""
    monkeypatch.setattr(ngram, "COUNT_SHARE", share)
    train = ["the cat sat on the mat", "a dog sat on the mat", "the cat ran", "the dog ran on a mat"] * 2 + ["once only"]
    held = ["the cat sat on the dog", "unseen words here", "", "a dog ran", "the cat unseen sat on"]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = {r["doc_id"]: r["score"] for r in ngram.score_documents(docs, lambda: F.col("learn")).collect()}
    for i, want in enumerate(plain_scores(train, held)):
        assert got[100 + i] == pytest.approx(want, abs=0.01)


def test_keys_of_pairs_tell_both_words():
    rng = np.random.default_rng(7)
    for bits in (16, 22, 31, 32):
        first, second = (np.append(rng.integers(0, 1 << bits, 5000), [0, 0, (1 << bits) - 1]) for _ in "ab")
        keys = ngram.scrambled(first, second, bits)
        assert (ngram.first_of(keys, bits) == first.astype(np.uint64)).all() and int(keys.max()) < 1 << 2 * bits
        assert len(np.unique(keys)) == len(set(zip(first.tolist(), second.tolist(), strict=True)))


def test_n_grams_on_their_way_are_small():
    """A block's pairs and triples take under five bytes each, counts included; ten by hashes with a copy of the context."""
    rng = np.random.default_rng(11)
    numbers, bounds = rng.integers(0, 1 << 22, 600_000), np.arange(0, 600_001, 200)
    learn = np.ones(len(numbers), bool)
    grams = ngram.Grams(numbers, bounds, 22)
    assert sum(len(level) for _, level in grams.levels(learn, 256)) < 5 * (len(grams.keys) + len(grams.triples))


def test_texts_are_scored_where_they_are_stored(spark):
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(30)], "doc_id long, text string")
    scored = ngram.score_documents(docs, lambda: F.col("doc_id") < 20)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    texts = next(part for part in plan.split("FileScan") if "text#" in part.split("\n")[0])
    assert "Bucketed: true" in texts
    assert scored.count() == 30


def test_quantisation_error():
    rng = np.random.default_rng(5)
    shares, counts = np.append(rng.uniform(1e-9, 1, 5000), [1e-10, 1.0]), np.append(rng.uniform(1, 1e9, 5000), [1.0, 1.25])
    for x, back in ((shares, ngram.probability), (counts, ngram.amount)):
        assert np.abs(back(ngram.quantised(x)) / x - 1).max() < 0.0002


def test_successors_are_sought_under_their_context_only():
    """Two contexts with one successor in common, one with none, and words that no context has."""
    pairs, under = np.array([5, 9, 70], np.uint64), [[3, 7], [], [7, 8]]
    triples = np.array([i << 32 | w for i, own in enumerate(under) for w in own], np.uint64)
    pointers = np.searchsorted(triples, np.arange(4, dtype=np.uint64) << np.uint64(32))
    parts = [x for y in (pairs, pointers, triples) for x in ngram._sequence(y)]
    trie = ngram.Trie(ngram.unpack(ngram.pack(*parts, *(np.zeros(n, np.uint16) for n in (3, 3, 4)))))
    assert trie.find_pairs(np.array([4, 5, 8, 9, 70, 71], np.uint64)).tolist() == [-1, 0, -1, 1, 2, -1]
    place = np.repeat(np.arange(3), 4)
    found = trie.find_successors(place, np.tile(np.array([2, 3, 7, 8], np.uint64), 3))
    assert found.tolist() == [-1, 0, 1, -1, -1, -1, -1, -1, -1, -1, 2, 3]


def test_elias_fano_gives_back_every_value():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 0), (1, 2**40), (1000, 50), (5000, 2**41), (3000, 2**62)):
        values = np.sort(rng.integers(0, top + 1, n))
        held = ngram.EliasFano(ngram.EliasFano.build(values))
        assert (held[np.arange(n)] == values).all()
        if n > 1:
            keys, at = np.unique(values, return_index=True)
            whole = np.zeros(len(keys), int)
            assert (values[held.find(whole, whole + n, keys)] == keys).all()
            assert (held.find(whole, whole + n, keys + 1) >= 0).sum() == np.isin(keys + 1, keys).sum()
            assert (held.find(whole, whole, keys) == -1).all()


# --- op10


def test_section_counts_add_up(spark, docs):
    encoding, sizes = token_counts._encoding(open(token_counts.VOCABULARY, "rb").read())
    frame = read(spark, SF_DIR, "documents").select("doc_id", "text")
    for rule in token_counts.RULES:
        rows = collections.defaultdict(list)
        for r in token_counts.section_tokens(frame, rule).collect():
            rows[r["doc_id"]].append(r)
        for doc_id, text in docs:
            own = sorted(rows[doc_id], key=lambda r: r["section"])
            assert sum(r["n_tokens"] for r in own) == pytest.approx(len(encoding.encode_ordinary(text)))
            assert [r["start_char"] for r in own] == [0] + [r["end_char"] for r in own[:-1]] and own[-1]["end_char"] == len(text)


def test_section_counts_equal_a_loop_over_tokens(spark, docs):
    encoding, _ = token_counts._encoding(open(token_counts.VOCABULARY, "rb").read())
    rows = collections.defaultdict(list)
    for r in token_counts.section_tokens(read(spark, SF_DIR, "documents").select("doc_id", "text"), "majority").collect():
        rows[r["doc_id"]].append(r)
    for doc_id, text in docs[:60]:
        own = sorted(rows[doc_id], key=lambda r: r["section"])
        char_of = [i for i, x in enumerate(text) for _ in x.encode()]
        tokens, crossing, at = [0] * len(own), [0] * len(own), 0
        for piece in map(encoding.decode_single_token_bytes, encoding.encode_ordinary(text)):
            first, last = char_of[at], char_of[at + len(piece) - 1]
            at += len(piece)
            shares = [max(0, min(last + 1, r["end_char"]) - max(first, r["start_char"])) for r in own]
            tokens[shares.index(max(shares))] += 1
            if sum(x > 0 for x in shares) > 1:
                crossing = [n + (x > 0) for n, x in zip(crossing, shares, strict=True)]
        assert [r["n_tokens"] for r in own] == tokens and [r["n_crossing"] for r in own] == crossing


def test_boundary_rules():
    bounds = np.array([0, 4, 5, 10])
    starts, ends = np.array([0, 2, 3, 6]), np.array([2, 5, 8, 10])
    # spans 0-2 | 2-5 (2 in the first, 1 in the second) | 3-8 (1, 1, 3) | 6-10
    count = lambda rule: token_counts.attribute(starts, ends, bounds, rule)[0].tolist()
    assert count("majority") == [2, 0, 2]
    assert count("start") == [3, 0, 1]
    assert count("split") == pytest.approx([1 + 2 / 3 + 1 / 5, 1 / 3 + 1 / 5, 1 + 3 / 5])
    assert token_counts.attribute(starts, ends, bounds, "start")[1].tolist() == [2, 2, 1]


def test_sections_of_a_text(spark):
    text = "One two. Three?  Four\nFive! \n\nSix 3.5 é日. End"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "a.")], "doc_id long, text string")
    rows = token_counts.section_tokens(docs).orderBy("doc_id", "section").collect()
    parts = [text[r["start_char"] : r["end_char"]] for r in rows if r["doc_id"] == 1]
    assert parts == ["One two. ", "Three?  ", "Four\n", "Five! \n\n", "Six 3.5 é日. ", "End"]
    assert [(r["section"], r["n_tokens"]) for r in rows if r["doc_id"] in (2, 3)] == [(0, 0), (0, 0)]
    lines = token_counts.section_tokens(docs, unit="line").where("doc_id = 1").orderBy("section").collect()
    assert [text[r["start_char"] : r["end_char"]] for r in lines] == text.splitlines(keepends=True)


# --- words


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    import pyarrow as pa

    from barloom.llm import common

    texts = ["The cat, the CAT", "", None, "cat" * 50 + " the é É ! 9", "  x", "y", prose(3, 300)]
    whole = Words(*text_bytes(pa.array(texts)))
    monkeypatch.setattr(common, "BLOCK_BYTES", 64)
    parts = Words(*text_bytes(pa.array(texts)))
    assert (whole.hash == parts.hash).all() and (whole.bounds == parts.bounds).all()
    names = [w for t in texts for w in words(t)]
    assert len(whole) == len(names) and len(set(names)) == len(set(whole.hash.tolist()))
    assert len(set(zip(names, whole.hash.tolist(), strict=True))) == len(set(names))
    assert [int(n) for n in np.diff(whole.bounds)] == [len(words(t)) for t in texts]
