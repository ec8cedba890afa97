"""Word sequences, collocations, fill-in-middle, redaction by place and the pipeline's rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from poolscope.llm import batches, collocation, fillmiddle, fmindex, jaccard, secretscan, substrings
from poolscope.llm.common import settled, stored
from poolscope.session import shared_dir

WORDS = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, key string, path string, words string, n string, score string, phrase string"
LONG = " ".join(f"word{k * k % 977} other{k % 13}" for k in range(12_000))
BASE = " ".join(f"alpha{k}" for k in range(60))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, BASE), (6, BASE), (6, BASE), (7, BASE.replace("alpha30", "beta")), (8, "one two"),
       (9, "one two"), (None, BASE), (None, None), (11, "é" * 120), (12, "😀é " * 40), (13, "x" * 150 + "y"), (14, LONG), (2, BASE + " " + BASE)]


def rows(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "k", "p", "w", "n", "s", "f") for i, t in texts], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- 11 word sequences


def plain_removal(texts, length=13):
    least = {}
    for i, text in texts:
        words = WORDS.findall(text or "")
        for k in range(len(words) - length + 1):
            if i is not None:
                least[tuple(words[k : k + length])] = min(i, least.get(tuple(words[k : k + length]), i))
    out = []
    for i, text in texts:
        words = WORDS.findall(text or "")
        gone = set()
        for k in range(len(words) - length + 1):
            if i is not None and least[tuple(words[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), sha(kept), kept))
    return Counter(out)


def shuffled_texts(seed, documents=120, vocabulary=40):
    draw = random.Random(seed)
    passages = [[f"p{draw.randrange(vocabulary)}" for _ in range(draw.randrange(5, 50))] for _ in range(6)]
    texts = []
    for i in range(documents):
        words = []
        for _ in range(draw.randrange(1, 6)):
            words += [f"W{draw.randrange(vocabulary)}" for _ in range(draw.randrange(0, 25))]
            words += draw.choice(passages)[draw.randrange(0, 4) :]
        texts.append((draw.choice([i, i, i, draw.randrange(documents), None]) if i % 9 == 0 else i, draw.choice([" ", "\n", "  "]).join(words)))
    return texts


@pytest.mark.parametrize("hot, shard, batch", [(5_000, 50_000, 8_000_000), (2, 40, 3_000), (0, 7, 500)])
def test_repeated_words_match_brute_force(spark, monkeypatch, hot, shard, batch):
    # small bounds: anchors are dealt out by window, many shards, many batches; results stay the same
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_SEGMENTS", shard)
    monkeypatch.setattr(substrings, "BATCH_BYTES", batch)
    texts = ODD + [(100 + i if i is not None else None, t) for i, t in shuffled_texts(hot)]
    found = substrings.remove_repeated_words(rows(spark, texts)).collect()
    assert Counter(tuple(r) for r in found) == plain_removal(texts)


def test_repeated_words_of_no_rows(spark):
    assert substrings.remove_repeated_words(rows(spark, [])).count() == 0
    alone = substrings.remove_repeated_words(rows(spark, [(1, BASE)]), with_text=False).collect()
    assert [tuple(r) for r in alone] == [(1, 60, 0, sha(BASE))]


@pytest.mark.parametrize("largest", [1, 2, 7, 300])
def test_index_ranks_and_matches(largest):
    draw = np.random.default_rng(largest)
    text = draw.integers(1, largest + 1, 4_000)
    text[draw.integers(0, len(text), 60)] = 0
    text[-1] = 0
    tree = fmindex.WaveletMatrix(text, largest)
    places = draw.integers(0, len(text) + 1, 500)
    symbols = draw.integers(0, largest + 1, 500)
    assert tree.rank(symbols, places).tolist() == [int((text[:p] == s).sum()) for s, p in zip(symbols, places)]
    index = fmindex.FMIndex(text, 6)
    whole = [k for k in range(len(text) - 6) if 0 not in text[k : k + 6]]
    occurrences = defaultdict(list)
    for size in range(1, 7):
        for k in range(len(text) - size + 1):
            occurrences[tuple(text[k : k + size])].append(k)
    starts = np.array(whole[:300], dtype=np.int64)
    statistic, low, high = index.matches(starts, 6)
    for k, s, lo, hi in zip(starts, statistic, low, high):
        several = [n for n in range(1, 7) if len(occurrences[tuple(text[k + 6 - n : k + 6])]) > 1]
        assert s == max(several, default=0)
        if s == 6:
            assert sorted(index.order[lo:hi]) == occurrences[tuple(text[k : k + 6])]
    again = statistic == 6
    values = draw.integers(0, 10**6, len(text))
    least = index.least(values, low[again], high[again])
    assert least.tolist() == [min(values[p] for p in occurrences[tuple(text[k : k + 6])]) for k in starts[again]]


# ---------------------------------------------------------------- 12 collocations


def plain_phrases(texts, least=10, share=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        kept = []
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= share * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def lines_of(seed, count=150):
    draw = random.Random(seed)
    words = [*"abcdefg", "É", "the", "Of", "x-y", "😀"]
    return [(draw.choice(["en", "de", None, "und"]), "".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ". ", ",", "\n", "!", "\x0b"]) for _ in range(
        draw.randrange(0, 80)))) for _ in range(count)]


@pytest.mark.parametrize("batch", [8_000_000, 2_000])
def test_phrases_match_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(collocation, "BATCH_BYTES", batch)
    texts = lines_of(batch) + [("fr", None), ("fr", ""), (None, LONG), ("en", LONG)]
    docs = spark.createDataFrame([(k, t, x, 1, 2, "w") for k, (x, t) in enumerate(texts)], "doc_id long, text string, lang string, a long, n long, w1 string")
    found = sorted(tuple(r) for r in collocation.mine_phrases(docs).collect())
    assert found == plain_phrases(texts) and len(found) > 20
    few = sorted(tuple(r) for r in collocation.mine_phrases(docs, least=3, share=80, top=7).collect())
    assert few == plain_phrases(texts, 3, 80, 7)


def test_phrases_of_no_rows(spark):
    assert collocation.mine_phrases(rows(spark, [])).count() == 0
    assert collocation.mine_phrases(rows(spark, [(1, None), (2, "")])).count() == 0


def test_phrase_scores_do_not_overflow(spark):
    # counts whose products pass 64 bits: the score's expression on its own
    big = 3 * 10**12
    counts = spark.createDataFrame(
        [("x", "", 0, 9 * big), ("x", "a", 1, big + 7), ("x", "b", 1, big + 1), ("x", "a b", 2, big)], "lang string, phrase string, size int, f long")
    found = collocation.ranked(counts, 50, 10).collect()
    assert [(r.a, r.l, r.r, r.n, r.score) for r in found] == [(big, big + 7, big + 1, 9 * big, 10**6 * big * big // ((big + 7) * (big + 1)))]


def test_longer_phrases(spark):
    docs = rows(spark, [(k, "a b c d e. a b c d f") for k in range(5)])
    counts = {(r.phrase, r.f) for r in collocation.phrase_counts(docs, longest=5, least=5).collect()}
    assert {("a b c d e", 5), ("a b c d", 10), ("b c d", 10), ("e", 5), ("", 50)} <= counts


# ---------------------------------------------------------------- 13 fill in the middle


UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_middle(i, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    first, second = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
    output = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return i, len(units), form, None if plain else len(p), None if plain else len(m), sha(output), sha(text), output


def test_middles_match_brute_force(spark):
    draw = random.Random(5)
    made = [(500 + k, "".join(draw.choice("ab é漢😀\n<>PSM1") for _ in range(draw.randrange(0, 900)))) for k in range(300)]
    texts = ODD + made + [(900, "a<P>b"), (901, "<S"), (902, "P>x<M"), (903, "\r\n\x0b"), (904, "<M>")]
    found = Counter(tuple(r) for r in fillmiddle.fill_in_middle(rows(spark, texts)).collect())
    assert found == Counter(plain_middle(*t) for t in texts)
    assert {k[2] for k in found} == {"plain", "psm", "spm"}
    assert fillmiddle.fill_in_middle(rows(spark, [])).count() == 0


def test_exceptions_convert_both_ways():
    text = "añb漢😀zz😀é" * 5
    data = np.frombuffer(text.encode(), np.uint8)
    index = fillmiddle.Exceptions(data)
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in chars])
    assert index.to_bytes(chars).tolist() == places.tolist() and index.to_chars(places).tolist() == chars.tolist()


def test_outputs_restore():
    for form in ("psm", "spm", "plain"):
        for text in (b"", b"<", b"ab<Scd>", b"P>x<M"):
            for a in range(len(text) + 1):
                for b in range(a, len(text) + 1):
                    assert fillmiddle.restore(fillmiddle.arrange(text, a, b, form), form) == text


# ---------------------------------------------------------------- 9 redaction by place


def test_secrets_are_replaced_where_they_are_found(spark):
    cases = {
        " é\n 😀 bob:a@host.org Mail banana a": " é\n 😀 bob:[SECRET]@host.org Mail banana a",
        "pwd = v2 and v2x v2": "pwd = [SECRET] and v2x v2",
        "password: SECRET SECRET": "password: [SECRET] SECRET",
        "x ABCDEFGHIJKLMNOP1.ABCDEFGHIJKLMNOP1 y": "x [SECRET].[SECRET] y",
        'pwd = "correct horse  battery" # correct': 'pwd = "[SECRET]" # correct',
        "api_key=Ab3dEf6hIj9k;": "[SECRET];",
        "nothing here": "nothing here",
    }
    docs = spark.createDataFrame([(None if k % 2 else k, t, f"k{k}", k) for k, t in enumerate(cases)], "doc_id long, text string, key string, spans long")
    found = secretscan.candidates(docs)
    texts = list(cases)
    by_key = {r.text_key: r.text for r in docs.select(secretscan.text_key(), "text").collect()}
    for r in found.collect():
        assert by_key[r.text_key][r.start : r.start + r["size"]] == r.candidate
    all_secret = found.withColumn("is_secret", F.lit(True))
    for bound in (200_000, 0):
        secretscan.BROADCAST_SPANS, kept = bound, secretscan.BROADCAST_SPANS
        clean = secretscan.redact(docs, all_secret)
        secretscan.BROADCAST_SPANS = kept
        assert clean.schema == docs.schema
        assert {r.spans: r.text for r in clean.collect()} == {k: cases[t] for k, t in enumerate(texts)}


def test_long_texts_with_many_secrets(spark):
    text = "\n".join(f"password: Pa{k}ss{k * 7919 % 1000}word plain words of line {k}" for k in range(1500))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secretscan.candidates(docs).withColumn("is_secret", F.lit(True))
    clean = secretscan.redact(docs, found).first().text
    assert clean == "\n".join(f"password: [SECRET] plain words of line {k}" for k in range(1500))


# ---------------------------------------------------------------- pipeline


def similar(word):
    return BASE.replace("alpha30", word)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2), (2, 0, 1)])
def test_repeated_ids_lose_no_text(spark, order):
    other = " ".join(f"beta{k}" for k in range(60))
    given = [(0, BASE), (1, BASE), (1, other)]
    left = corpus_pipeline.drop_near_duplicates(spark, rows(spark, [given[k] for k in order]).coalesce(1), SF)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(0, BASE), (1, other)])


def test_near_duplicates_of_odd_rows(spark):
    docs = rows(spark, ODD + [(3, BASE), (None, similar("x")), (None, "a b c d e f"), (None, "a b c d e f"), (20, None), (21, "")])
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert left.schema == docs.schema
    # rows of one id with different texts are rows of their own; words alone decide
    expected = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (2, BASE + " " + BASE), (3, BASE), (8, "one two"), (None, None),
                (11, "é" * 120), (12, "😀é " * 40), (13, "x" * 150 + "y"), (None, "a b c d e f"), (20, None), (21, "")]
    twice = {tuple((BASE + " " + BASE).split()[k : k + 5]) for k in range(116)}
    once = {tuple(BASE.split()[k : k + 5]) for k in range(56)}
    if 100 * len(twice & once) >= 75 * len(twice | once):  # one group then, whose least id is 2
        expected.remove((3, BASE))
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(expected)


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({
        "score": F.lit("given"), "lang_pred": F.lit(7), "_lettered": F.lit(1.5), "_key": F.lit("k"), "_secrets": F.lit("s"), "key": F.lit("x"),
        "spans": F.lit(3), "row": F.lit("r"), "id": F.lit(4), "tie": F.lit("t"), "worded": F.lit(True), "_row": F.lit(9), "a b.c": F.lit(1)})
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, SF)
        assert [(f.name, f.dataType) for f in seen.schema] == [(f.name, f.dataType) for f in docs.schema]
    extra = [c for c in docs.columns if c not in ("text", "n_chars")]
    given = {r.doc_id: r for r in docs.collect()}
    for r in seen.collect():
        assert all(r[c] == given[r.doc_id][c] for c in extra)


def test_tables_on_the_way_are_removed(spark):
    from pathlib import Path

    folder = Path(shared_dir(spark).removeprefix("file:"))

    def make():
        first = stored(spark.range(5), "on-the-way")
        return settled(lambda: stored(first.union(first), "inner"), "half").filter("id > 2")

    kept = settled(make, "whole")
    assert sorted(r.id for r in kept.collect()) == [3, 3, 4, 4]
    assert not [p for p in folder.iterdir() if p.name.startswith(("on-the-way", "inner", "half"))]


def test_batches_of_word_texts_hold_every_row(spark):
    made = batches.write_batches(rows(spark, ODD).select("doc_id", "text"), "r3", size=400)
    held = [x for r in made.manifest.collect() for x in batches.load_batch(r.path).rows.column("doc_id").to_pylist()]
    assert Counter(held) == Counter(i for i, _ in ODD)
    assert pa.__version__


def test_repeated_rows_are_one_set(spark):
    near = similar("x")
    texts = [(1, BASE)] * 300 + [(2, near)] * 300 + [(3, " ".join(f"g{k}" for k in range(40)))]
    found = Counter((r.doc_id, r.component_id) for r in jaccard.jaccard_components(rows(spark, texts)).collect())
    assert found == {(1, 1): 300, (2, 1): 300, (3, 3): 1}
