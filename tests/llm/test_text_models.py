import random
import zlib

import numpy as np
import pytest

from assaysift.llm import decontaminate, language, licenses, toxicity

SF = "/root/testdata/sf0.01"
ODD = [(None, None, "x", 1), (1, "", "x", 1), (2, " \n\t", None, 2), (2, "Ein Wort", "y", 3), (3, "word " * 40_000, "z", 4), (4, "12 ** 3", "w", 5)]
ODD_SCHEMA = "doc_id long, text string, score string, ratio int"


# toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    bad = ["vile", "vilest", "scumlike"]
    docs, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.choice([5, 40, 200]))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text), "en"))
        labels.append((i, toxic, 1))
    labels += [(9999, 1, 0), (None, 0, 0), (5, None, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    return toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_toxic_words_decide_at_any_length(spark, toxic_model):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    clean = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 50, 400)]
    for text in clean:
        assert toxic_model.score(*toxic_model.ratio(text)) < 0.5
    for text in clean[:2]:
        assert toxic_model.score(*toxic_model.ratio(f"vile {text} Vilest! {text} scumlike")) > 0.5


def test_probabilities_sum_to_one_over_known_words(toxic_model):
    for c in (0, 1):
        assert 0.5 < toxic_model.unigram[c, 1:].sum() <= 1.0 + 1e-9
        assert toxic_model.context[c].min() > 0 and toxic_model.context[c].max() <= 1.0


def test_toxicity_of_odd_rows(spark, toxic_model):
    df = spark.createDataFrame(ODD, ODD_SCHEMA)
    got = toxicity.score(df, toxic_model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.n_words == 0}) == 1  # null, empty, blank and wordless alike
    assert toxicity.score(df.limit(0), toxic_model).count() == 0
    assert toxicity.keep_civil(df, toxic_model).columns == df.columns
    assert toxicity.keep_civil(df, toxic_model).count() == len(ODD)


def test_without_labels_all_score_alike(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert len({r.score for r in toxicity.score(df, toxicity.fit(df, labels)).collect()}) == 1


def test_pairs_reach_the_driver_by_the_part(spark, toxic_model, monkeypatch):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [(i, " ".join([rng.choice(words) for _ in range(9)] + ["vile"] * (i % 4 == 0))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    whole, sizes, part = toxicity.fit(docs, labels), [], toxicity._pair_part
    monkeypatch.setattr(toxicity, "_PAIRS_AT_ONCE", 10)
    monkeypatch.setattr(toxicity, "_pair_part", lambda held, *rest: sizes.append(held.num_rows) or part(held, *rest))
    parts = toxicity.fit(docs, labels)
    assert len(sizes) > 3 and sum(sizes) == len(parts.pairs) and max(sizes) < len(parts.pairs) / 2
    for name in ("words", "unigram", "context", "pairs", "pair_mass"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name))


def test_held_out_toxicity(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = toxicity.op1_toxicity(spark, SF).collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    clean = [r for r in got if truth.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)  # few toxic rows to learn from at this size


# language


def brute_phrases(text, reference):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in reference:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def test_phrases_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        reference = "".join(rng.choice("abc ") for _ in range(rng.randrange(40)))
        text = "".join(rng.choice("abcd ") for _ in range(rng.randrange(25)))
        assert language.phrases(text, language.suffix_automaton(reference)) == brute_phrases(text, reference)


@pytest.fixture(scope="module")
def language_model(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog with that", "en"), ("der hund und die katze nicht", "de"), ("12", "xx"), (None, "en"), ("le chat", None)] * 5)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages_of_odd_rows(spark, language_model):
    assert language_model.languages == ("de", "en")
    df = spark.createDataFrame([*ODD, (5, "the DOG", "a", 1), (5, "die Katze", "a", 1)], ODD_SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(df, language_model).collect()}
    assert {(None, "und"), (1, "und"), (2, "und"), (4, "und"), (5, "en"), (5, "de")} <= got
    assert language.identify(df.limit(0), language_model).count() == 0
    kept = language.keep_languages(df, language_model)
    assert kept.columns == df.columns and kept.count() == 4
    assert language.keep_languages(df, language_model, languages=("de",)).where("text like 'die%'").count() == 1


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").selectExpr("*", "cast(null as string) as lang")
    assert [(r.lang_pred, r.score) for r in language.identify(df, language.fit(df)).collect()] == [("und", 0.0)]


def test_held_out_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = language.op4_language_id(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


# decontamination


def brute_contained(text, item, containment=0.8):
    words, own = decontaminate.words_of(text or ""), decontaminate.words_of(item or "")
    n = min(5, len(own))
    if not own:
        return False
    grams = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return len(grams(own) & grams(words)) >= containment * len(grams(own)) - 1e-9


def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 4, 5, 6, 9, 14, 20, 33, 60, 60)] + [None, "", "..."]
    docs = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.choice([0, 3, 30, 300]))]
        item = (rng.choice(items) or "").split()
        if item and rng.random() < 0.7:
            item = [w if rng.random() > 0.04 else "zz" for w in item]
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        docs.append(" ".join(text).title() if i % 2 else ", ".join(text))
    docs += [None, "", docs[0]]
    d = spark.createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id long, text string, n_shared int").repartition(3)
    b = spark.createDataFrame([(100 + i, t) for i, t in enumerate(items)], "item_id long, text string")
    true = {(i, 100 + j) for i, t in enumerate(docs) for j, item in enumerate(items) if brute_contained(t, item)}
    assert len(true) > 50
    for chars in (10**6, 200):
        got = [(r.doc_id, r.item_id) for r in decontaminate.contained_items(d, b, block_chars=chars).collect()]
        assert len(got) == len(set(got)) and set(got) == true
        kept = decontaminate.drop_contaminated(d, b, block_chars=chars)
        assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {i for i, _ in true}
    assert decontaminate.contained_items(d, b.limit(0)).count() == 0
    assert decontaminate.contained_items(d.limit(0), b).count() == 0
    assert decontaminate.drop_contaminated(d, b.limit(0)).count() == len(docs)


# licenses


def test_licenses_are_told_apart(spark):
    apache = licenses.TEMPLATES["Apache-2.0"][1][1]
    wrapped = "\n".join(apache[i : i + 60] for i in range(0, len(apache), 60))
    texts = {
        1: "Intro text.\nLicensed under the Apache License, Version 2.0.\nMore.",
        2: "Released under the MIT License.",
        3: "x\nLicensed under CC BY-NC 4.0.",
        4: "Licensed under CC BY-SA 4.0.",
        5: "This work is licensed under the GNU General Public License, version 3.",
        6: f"Header\n\n{wrapped}\n\nBody of the file.",
        7: "The driver had a licence to drive in the city and many other things that no notice says.",
        8: "All rights reserved.",
        9: None,
        10: "",
        11: "plain " * 10_000,
        12: "Licensed under the Apache License, Version 1.0.",
    }
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, license string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    confirmed = {k: r.license for k, r in got.items() if r.confirmed}
    assert confirmed == {1: "Apache-2.0", 2: "MIT", 3: "CC-BY-NC-4.0", 4: "CC-BY-SA-4.0", 5: "GPL-3.0", 6: "Apache-2.0", 8: "all-rights-reserved"}
    assert texts[1][got[1].start : got[1].start + got[1].length] == "Licensed under the Apache License, Version 2.0."
    assert got[12].license == "Apache-2.0" and got[12].extra == "1.0" and got[12].missing == "2.0"
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8, 12}
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_blocks_over_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = licenses.op5_license_scan(spark, SF).collect()
    lines = {(k, line) for k, t in texts.items() for line in (t or "").split("\n") if licenses._CUE.search(line)}
    assert {(r.doc_id, texts[r.doc_id][r.start : r.start + r.length]) for r in got} == lines
    assert sum(r.confirmed for r in got) >= 0.9 * len(got)


def test_words_and_letters_of_any_context_sum_to_one(toxic_model):
    assert np.allclose(toxic_model.unigram.sum(axis=1), 1.0)
    spelling = toxic_model.spelling
    for context in ("", "v", "vi", "vil", "zzz", "wor"):
        last = toxicity.letter_codes([context])[0]
        before = (int(last[-1]) >> toxicity._LETTER_BITS if len(context) == 0 else int(last[-2])) if len(last) > 1 or not context else 0
        runs = (before << toxicity._LETTER_BITS | np.arange(4_096)) & ((1 << toxicity._LETTERS * toxicity._LETTER_BITS) - 1)
        odds, both = spelling.odds(runs)
        assert both.sum() == pytest.approx(1.0, abs=1e-6)
        assert (odds * both).sum(axis=1) == pytest.approx([1.0, 1.0], abs=1e-6)


def test_runs_of_letters():
    runs, word = toxicity.letter_codes(["ab", "", "abcdef"])
    spelled = ["".join(chr(int(r) >> toxicity._LETTER_BITS * i & 4095) for i in range(4, -1, -1)).strip("\0") for r in runs]
    assert spelled == ["a", "ab", "ab\1", "\1", "a", "ab", "abc", "abcd", "abcde", "bcdef", "cdef\1"]
    assert word.tolist() == [0] * 3 + [1] + [2] * 7
