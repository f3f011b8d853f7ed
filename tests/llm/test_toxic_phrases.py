import random

from assaysift.llm import toxicity


def test_phrases_of_ordinary_words(spark):
    """Every word is common in both classes; only the fixed phrase, in few texts, tells them apart."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]

    def text(toxic):
        out = [rng.choice(words) for _ in range(rng.choice([20, 60, 120]))]
        at = rng.randrange(len(out))
        return " ".join([*out[:at], *(["ak", "bl", "cm"] if toxic else []), *out[at:]])

    rows = [(i, text(i % 8 == 0), int(i % 8 == 0)) for i in range(400)]
    model = toxicity.fit(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    fresh = [(text(toxic), toxic) for toxic in (True, False) for _ in range(60)]
    found = [(model.score(*model.ratio(t)) >= 0.5, toxic) for t, toxic in fresh]
    assert sum(p for p, toxic in found if toxic) >= 54
    assert sum(p for p, toxic in found if not toxic) <= 3


def test_recall_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(r.predicted, truth[r.doc_id]) for r in toxicity.op1_toxicity(spark, sf).collect() if r.held_out and r.doc_id in truth]
    toxic, civil = ([p for p, t in got if t == c] for c in (1, 0))
    assert sum(toxic) >= 0.75 * len(toxic) and sum(civil) <= 0.01 * len(civil)
