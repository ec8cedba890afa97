"""Corpus operators: odd rows, empty tables, brute force and round trips."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import connect, differences
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from poolscope.llm import (batches, interpolation, jaccard, langid, linefirst, packing, prefixfree, secretscan, templates, tokenfiles,
                           tokens, urlfilter, words)
from poolscope.llm.common import connected_components
from poolscope.llm.queries import QUERIES
from poolscope.llm.reference_sql import REFERENCE_SQL

WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, class string, score string, a long, b long, n string"
LONG = " ".join(f"word{k * k % 977} other{k % 13}" for k in range(12_000))
BASE = " ".join(f"alpha{k}" for k in range(60))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, BASE), (6, BASE), (6, BASE), (7, BASE.replace("alpha30", "beta")), (8, "one two"),
    (9, "one two"), (10, "ONE Two"), (None, BASE), (None, None), (11, "é" * 120), (12, "é" * 240), (13, "x" * 150 + "y"),
]


def rows(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", None, "t", "c", "z", 1, 2, "m") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return rows(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return rows(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(REFERENCE_SQL))
def test_query_against_sql(spark, name):
    assert differences(spark, connect(SF), QUERIES[name], REFERENCE_SQL[name], SF) == []


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---------------------------------------------------------------- shared parts


def test_words_and_shingles_match_plain_python():
    texts = [t for _, t in TEXTS] + ["a\x0bb\xa0c d", "ß É é", "\x1cx y"]
    for first, data, offsets in words.text_slices(pa.array(texts), 500):
        for k, found in enumerate(words.shingle_sets(data, offsets, 5)):
            own = WORDS.findall(lower(texts[first + k]))
            plain = {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} - {()}
            assert len(found) == len(plain)


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 100)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "t").collect())
    assert all(found[k] == 0 for k in range(41)) and {found[k] for k in (90, 95, 100, 200)} == {90} and len(found) == 45


def test_chunks_encode_like_whole_texts():
    texts = ["it's  I'm\n\n 'LL", "<|endoftext|> x", "", " ", "a   b", "é́ İ ٣", *(t or "" for _, t in TEXTS)]
    for name, keep_space in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        encode = tokens.encoder(public_tokenizers.path(name), keep_space)
        plain = [e.ids + [2] for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for first, data, offsets in words.text_slices(pa.array(texts), 1000):
            ids, begins = encode.encode(data, offsets, 2)
            for k in range(len(offsets) - 1):
                assert ids[begins[k] : begins[k + 1]].tolist() == plain[first + k]


# ---------------------------------------------------------------- 1 decontamination


def test_templates(spark, none):
    item = "If Anna buys 12 apples and 7 pears then how much fruit will Anna carry over the long road to the old market?"
    again = item.replace("12", "15").replace("Anna", "Peter").replace("7", "30")
    mixed = item.replace("Anna buys", "Peter buys")  # two names where the item has one; both lie in one window
    bench = spark.createDataFrame([(1, item, "x"), (2, "too short", "x"), (3, None, "x"), (None, None, "x")], "item_id long, text string, doc_id string")
    docs = rows(spark, [(1, "Then we saw. " + again + " Good."), (2, "Nothing of it here at all, but quite some words in a plain row."),
                        (3, "so " + item), (4, mixed), (5, None), (6, ""), (3, "so " + item), (7, BASE)])
    found = {r.doc_id: r for r in templates.contaminated(docs, bench).collect()}
    assert set(found) >= {1, 3} and set(found) <= {1, 3, 4}
    assert found[1].n_windows == found[1].item_windows and found[3].n_same == found[3].item_windows
    assert 4 not in found or found[4].n_windows < found[4].item_windows
    assert templates.contaminated(none, bench).count() == 0
    assert templates.contaminated(docs, bench.limit(0)).count() == 0


def test_planted_passages(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    plain = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert {(r.doc_id, r.item_id) for r in templates.contaminated(documents, bench).collect()} == plain


# ---------------------------------------------------------------- 2 repeated substrings


def plain_removal(texts):
    seen, out = set(), {}
    for doc, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(data[k : k + 100])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def test_prefix_free_parsing(spark, documents, none):
    texts = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
    start = 1 + max(i for i, _ in texts)
    texts += [(start + k, t) for k, (_, t) in enumerate(TEXTS)]
    found = prefixfree.remove_repeats(rows(spark, texts).repartition(5)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == plain_removal(texts)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in found)
    assert prefixfree.remove_repeats(none).count() == 0


def test_repeats_without_ids(spark, odd):
    found = prefixfree.remove_repeats(odd, with_text=False).collect()
    assert len(found) == len(TEXTS)
    # rows without an id come first, so the row without an id keeps the text
    kept = sorted(r.n_removed for r in found if r.n_bytes == len(BASE))
    assert kept == [0, len(BASE), len(BASE), len(BASE)]


# ---------------------------------------------------------------- 3 language


def test_language(spark, documents, odd, none):
    held = documents.withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    found = langid.predict(held.select("text", "lang", "held"), langid.fit(held.filter("NOT held"))).filter("held").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    net = langid.fit(documents)
    scored = langid.predict(odd, net).collect()
    assert len(scored) == len(TEXTS) and all(0 <= float(r.score) <= 1 for r in scored)
    assert {r.lang_pred for r in scored if r.doc_id in (1, 2, 3)} == {"und"}
    assert langid.fit(none) is None and langid.predict(odd, None).filter("lang_pred <> 'und'").count() == 0
    assert langid.predict(none, net).count() == 0


def test_copies_of_a_text_leave_others_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "train", lambda windows, labels, languages: (Counter(labels.tolist()), languages))
    texts = [(k, f"text number {min(k, 100)}") for k in range(3000)]
    docs = rows(spark, texts, "aa").union(rows(spark, [(k, f"words of {k}") for k in range(40)], "bb"))
    counts, languages = langid.fit(docs, langid.Sample(50, 4))
    # about 50 of 101 texts and all 40, each of one window
    assert languages == ("aa", "bb") and 25 <= counts[0] <= 75 and counts[1] == 40


# ---------------------------------------------------------------- 4 token files


def test_bit_packing():
    for bits in (1, 5, 16, 17, 31):
        ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64)
        assert (tokenfiles.unpack(tokenfiles.pack(ids, bits), bits)[:1000] == ids).all()
    assert [tokenfiles.bits_for(n) for n in (1, 2, 3, 50257, 65537)] == [1, 1, 2, 16, 17]


def test_token_files(spark, odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = f"file://{tmp_path}/out"
    tokenfiles.write_tokens(odd, folder, path, keep_space=True, end_id=2)
    found = sorted((tuple(r) for r in tokenfiles.read_digests(spark, folder).collect()), key=lambda r: r[1])
    encode = tokens.encoder(path, True).tokenizer
    expected, start = [], 0
    for doc, text in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = encode.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert found == expected
    first = tokenfiles.TokenFile(tokenfiles.manifest(spark, folder).orderBy("start").first().path)
    assert (first.document(3) == first.ids(0, int(first.begins[-1]))[first.begins[3] : first.begins[4]]).all()
    tokenfiles.write_tokens(none, f"file://{tmp_path}/none", path, keep_space=True, end_id=2)
    assert tokenfiles.read_digests(spark, f"file://{tmp_path}/none").count() == 0


# ---------------------------------------------------------------- 5 packing


def check_packing(texts, found, window=4096):
    encode = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"), False).tokenizer
    plain = Counter((d, tuple(encode.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, pieces in by_doc.items():
        wanted = sum(len(ids) * n for (d, ids), n in plain.items() if d == doc)
        assert sum(p.length for p in pieces) == wanted
        options = [np.array(ids, "<u4") for (d, ids) in plain if d == doc]
        for p in pieces:
            assert any(p.doc_tokens == len(ids) and zlib.crc32(ids[p.start : p.start + p.length]) == p.ids_crc32 for ids in options)
    assert set(by_doc) == {d for d, _ in texts}
    for pieces in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= window
    return sum(n for p in by_sequence.values() for _, n in p) / (window * len(by_sequence))


def test_packing(spark, documents, odd, none):
    def pack(docs):
        return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_space=False, end_id=2)

    texts = [(r.doc_id, r.text) for r in documents.collect()]
    assert check_packing(texts, pack(documents).collect()) > 0.97
    check_packing(TEXTS, pack(odd).collect())
    assert pack(none).count() == 0


def test_neighbours_share_words():
    lengths = np.array([60, 50, 50, 50])
    ids = np.concatenate([np.arange(60), np.arange(100, 150), np.arange(20, 70), np.arange(200, 250)])
    index = packing.Index(ids, lengths, np.ones(300), 52.0)
    assert index.scores(0)[2] > 0 and index.scores(0)[1] == 0
    assert [d for d, _, _ in next(packing.fill(lengths, index, 110))] == [0, 2]


# ---------------------------------------------------------------- 6 language model


def test_interpolation(spark, documents, odd, none):
    texts = [(r.doc_id, r.text) for r in documents.collect()] + [(10_000, None), (10_001, "")]
    train = {d: zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in texts}
    docs = rows(spark, texts).withColumn("train", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    own = {d: WORDS.findall(lower(t)) + ["\0end"] for d, t in texts}
    counts = Counter(w for d, ws in own.items() if train[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    found = interpolation.score_documents(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        ws = own[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        assert r.score < 0
    held = [r for r in found if not r.train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    untrained = interpolation.score_documents(odd.withColumn("train", F.lit(None).cast("boolean"))).collect()
    assert len(untrained) == len(TEXTS) and {r.score for r in untrained} == {0.0}
    assert interpolation.score_documents(none.withColumn("train", F.lit(True))).count() == 0


def test_weights_follow_held_out_counts():
    level = interpolation.LEVELS
    cells = np.array([(3 * level + 4) * level + 40, (5 * level + level - 1) * level + 8])
    weights = interpolation.learn_weights(cells, np.array([100.0, 100.0]), 1e-6)
    assert weights[3, 0] > 0.9 and weights[5, 1] > 0.9 and np.allclose(weights.sum(axis=1), 1)


# ---------------------------------------------------------------- 7 addresses


def test_redirect_classes(spark):
    rules = spark.createDataFrame([("bad.org", "/", "block"), ("good.bad.org", "/", "allow"), ("bad.org", "/", "block")], "host string, path string, action string")
    page = "<html><link rel='canonical' href='{}'><meta http-equiv=refresh content='0; url=http://r.net/x'></html>"
    pages = spark.createDataFrame([
        (1, "http://bad.org/a", None, "x"), (2, "http://alias.com/a", page.format("http://bad.org/a"), "x"), (3, "https://www.r.net/x/#f", "", "x"),
        (4, "http://other.com/", "<p>canonical refresh</p>", "x"), (5, None, None, "x"), (6, "no address", page, "x"), (7, "http://Good.Bad.org/z?utm_a=1", "", "x"),
        (8, "http://late.com/", page.format("http://good.bad.org/z"), "x"), (1, "http://bad.org/a", None, "x"), (9, "", None, "x"),
        (None, "http://lone.org", None, "x")], "page_id long, url string, html string, component string")
    found = {r.page_id: r for r in urlfilter.judge(pages.filter("page_id <> 8 OR page_id IS NULL"), rules).collect()}
    # page 6 has no host, but its refresh target is one of a blocked class
    assert {k: r.verdict for k, r in found.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "allow", 9: "allow", None: "allow"}
    assert (found[5].host, found[5].path, found[5].rule) == ("", "", None) and found[7].rule == "good.bad.org/"
    # page 8 ties the allowed address to the class: allow has precedence for those without a rule
    joined = {r.page_id: r.verdict for r in urlfilter.judge(pages, rules).collect()}
    assert (joined[1], joined[2], joined[3], joined[8]) == ("block", "allow", "allow", "allow")
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert urlfilter.judge(pages, rules.limit(0)).filter("verdict <> 'allow'").count() == 0


def test_relative_links(spark):
    link, refresh = "<link rel='canonical' href='{}'>", "<meta http-equiv=refresh content='0; url={}'>"
    cases = [
        (link.format("/es/a?x=1&amp;y=2"), "http://a.net/es/a?x=1&y=2"), (link.format("//b.net/es/"), "http://b.net/es/"),
        (refresh.format("/es"), "http://a.net/es"), (refresh.format("x/../y.html"), "http://a.net/d/y.html"), (link.format("../es/z"), "http://a.net/es/z"),
        (link.format("http://c.org/q"), "http://c.org/q"), (link.format("?p=2"), "http://a.net/d/p?p=2"), (link.format("mailto:x"), None),
        ("<LINK HREF='/es/b' REL='CANONICAL'>", "http://a.net/es/b"), ('<link rel="shortlink canonical" href="/es/c">', "http://a.net/es/c"),
        ("<base href='/es/'>" + link.format("d"), "http://a.net/es/d"), (link.format("/r?u=http://x.org"), "http://a.net/r?u=http://x.org"),
        ("<link data-rel=canonical href='/no'>", None), ("<p>canonical", None)]
    pages = spark.createDataFrame([(k, f"http://a.net/d/p?n={k}", html) for k, (html, _) in enumerate(cases)], "page_id long, url string, html string")
    found = {int(r.a.split("=")[1]): r.b for r in urlfilter.links_of(pages).collect()}
    assert [found.get(k) for k in range(len(cases))] == [b for _, b in cases]
    rules = spark.createDataFrame([("net", "/es/", "block")], "host string, path string, action string")
    verdicts = {r.page_id: r.verdict for r in urlfilter.judge(pages, rules).collect()}
    assert {k for k, v in verdicts.items() if v == "block"} == {0, 1, 4, 8, 9, 10}


# ---------------------------------------------------------------- 8 lines


def test_lines(spark, odd, none):
    good = "\n".join(" ".join(f"word{k}{chr(97 + j)}" for j in range(9)) + " ends here." for k in range(12))
    menu = "Home | News | Sport | Contact\n" * 12 + "Accept all cookies.\nno closing mark here at all in this line of words\n"
    docs = rows(spark, [(1, good), (2, good + "\n" + "Home | News | Sport | Contact"), (3, menu * 3 + good[:80])])
    found = {r.doc_id: r for r in linefirst.measure(docs).collect()}
    assert found[1].kept and found[2].kept and found[2].cleaned == good and not found[3].kept
    assert found[2].line_rules[-1] == "navigation" and {"boilerplate", "punctuation"} <= set(found[3].line_rules)
    rest = linefirst.measure(odd).collect()
    assert len(rest) == len(TEXTS) and all((r.n_words, r.word_chars, r.kept) == (0, 0, False) for r in rest if r.doc_id in (1, 2, 3))
    assert linefirst.measure(none).count() == 0


# ---------------------------------------------------------------- 9 secrets


def test_secrets(spark, odd, none):
    documents = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")  # the smaller table has no secrets
    found = secretscan.scan(documents)
    planted = {(r.doc_id, x) for r in documents.collect() for x in re.findall(r'token = "([0-9a-f]{40})"', r.text)}
    assert planted and planted <= {(r.doc_id, r.candidate) for r in found.filter("is_secret").collect()}
    assert found.filter("is_secret AND candidate RLIKE '^[a-z]+$'").count() == 0
    clean = secretscan.redact(documents, found)
    assert clean.columns == documents.columns and clean.count() == documents.count()
    assert clean.filter(F.col("text").rlike('token = "[0-9a-f]{40}"')).count() == 0
    assert secretscan.scan(none).count() == 0 and secretscan.scan(odd).filter("is_secret").count() == 0
    assert secretscan.redact(odd, secretscan.scan(odd)).count() == len(TEXTS)


def test_copies_of_a_finding_leave_others_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(secretscan, "TRAINING_ROWS", 100)
    zeros = [F.lit(0.0).alias(k) for k in secretscan.FEATURES[1:]]
    # 5000 copies of one secret beside 60 others, 5000 copies of one plain finding beside 60
    number = F.when(F.col("id") % 5060 < 60, F.col("id") % 5060).otherwise(60).cast("double")
    found = spark.range(10_120).select((F.col("id") < 5060).cast("double").alias("label"), number.alias("length"), *zeros)
    kept = secretscan.drawn(found).collect()
    assert Counter(r.label for r in kept) == {0.0: 61, 1.0: 61} and {r.weight for r in kept} == {1.0, 10.0}


def test_short_and_broken_secrets_are_candidates(spark):
    cases = {
        'password = "Tr0ub4dor&3" end': "Tr0ub4dor&3", "api_key=Ab3dEf6hIj9k;": "Ab3dEf6hIj9k", "see postgres://user:p!s@db.x/y now": "p!s",
        "user:hunter2@host.org": "hunter2", "the secret: abcdefghijklmnop.qrst!uvwx%yz": "abcdefghijklmnop.qrst!uvwx%yz",
        '{"db_password":"x.y~z"}': "x.y~z", 'pwd = "correct horse  battery" # x': "correct horse  battery", "token =a@b": "a@b",
        "MY_SECRET: 'a b' and": "a b", "https://h.org/a:b see http://x:80/": None, "a plain text: of words = here": None}
    found = secretscan.candidates(rows(spark, list(enumerate(cases)))).collect()
    texts = list(cases)
    for k, (text, wanted) in enumerate(cases.items()):
        own = {r.candidate for r in found if r.doc_id == k}
        assert wanted in own if wanted else not own, (text, own)
    assert all(r.candidate in texts[r.doc_id] for r in found)
    clean = secretscan.redact(rows(spark, list(enumerate(cases))), secretscan.candidates(rows(spark, list(enumerate(cases)))).withColumn("is_secret", F.lit(True)))
    assert not any(cases[texts[r.doc_id]] and cases[texts[r.doc_id]] in r.text for r in clean.collect())


# ---------------------------------------------------------------- 10 near duplicates


def test_components_of_odd_rows(spark, odd, none):
    found = Counter(tuple(r) for r in jaccard.jaccard_components(odd).collect())
    assert found[(6, 56, 5)] == 2 and found[(7, 56, 5)] == 1 and found[(5, 56, 5)] == 1
    assert all(found[(k, 0, k)] == 1 for k in (1, 2, 3)) and found[(9, 1, 8)] == found[(10, 1, 8)] == 1
    assert sum(found.values()) == len(TEXTS) - 2
    assert jaccard.jaccard_components(none).count() == 0


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_joined_pairs_are_all_pairs(spark, percent):
    draw = np.random.default_rng(percent)
    texts = []
    for group in range(12):
        base = [f"w{x}" for x in draw.integers(0, 400, 80)]
        for _ in range(8):
            own = list(base)
            for k in draw.integers(0, 80, draw.integers(0, 5)):
                own[k] = f"v{draw.integers(0, 10_000)}"
            texts.append((len(texts), " ".join(own)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for _, t in texts]
    root = list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(rows(spark, texts), percent=percent).collect()}
    assert found == dict(enumerate(root))


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark, documents):
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[0] == documents.filter(F.col("text").rlike(r"\p{L}")).count()
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_rows_without_ids_lose_secrets_and_leaks(spark):
    documents = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")  # the smaller table has no secrets
    bare = documents.withColumn("doc_id", F.lit(None).cast("long"))
    given = bare.filter(F.col("text").rlike('token = "[0-9a-f]{40}"'))
    assert given.count() > 0
    clean = corpus_pipeline.redact_secrets(spark, bare, SF)
    assert clean.count() == bare.count() and clean.filter(F.col("text").rlike('token = "[0-9a-f]{40}"')).count() == 0
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    docs = rows(spark, [(None, "Before it. " + item + " After it."), (None, BASE), (None, None), (5, BASE), (6, item)])
    left = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter([(None, BASE), (None, None), (5, BASE)])


@pytest.mark.parametrize("which", ["odd", "none"])
def test_pipeline_stages_of_odd_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == request.getfixturevalue(which).columns
    corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_batches_hold_every_row_once(spark, odd):
    made = batches.write_batches(odd.select("doc_id", "text"), "t", size=500)
    paths = [r.path for r in made.manifest.collect()]
    held = [x for p in paths for x in batches.load_batch(p).rows.column("doc_id").to_pylist()]
    assert len(paths) > 3 and Counter(held) == Counter(d for d, _ in TEXTS)
