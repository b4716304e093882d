import corpus_pipeline
from strider.llm import quality_crf, simhash_dedup
from strider.sources.bindings import read_table
from tests.llm.test_packing import check_pieces
from tests.llm.test_simhash import brute_components, brute_fingerprint

BASE = "/root/testdata/sf0.001"
ODD = [(1, "Same text here, of good words."), (2, "same text here, of good words."), (2, "same text here, of good words."),
       (3, None), (4, ""), (None, "no key at all"), (None, None), (5, "word " * 30000), (6, "other words " * 3)]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(spark, base):
    """Every stage by its plain definition, on the driver (the classifier's own answers taken)."""
    rows = {r.doc_id: r.text for r in read_table(spark, base, "documents").collect()}
    docs = read_table(spark, base, "documents")
    model = quality_crf.fit(docs, read_table(spark, base, "labels"))
    good = {r.doc_id for r in quality_crf.score(docs, model).where("predicted = 1").collect()}
    rows = {i: t for i, t in rows.items() if i in good}
    last = {}
    for i in sorted(rows):
        last[lowered(rows[i])] = i
    rows = {i: t for i, t in rows.items() if last[lowered(t)] == i}
    components = brute_components({i: brute_fingerprint(t) for i, t in rows.items()})
    rows = {i: t for i, t in rows.items() if components[i] == i}
    items = [" ".join((r.text or "").lower().split()) for r in read_table(spark, base, "benchmark").collect()]
    return {i: t for i, t in rows.items() if not any(x in " ".join(t.lower().split()) for x in items if len(x) >= 8)}


def test_run_equals_the_stages_by_definition(spark):
    pieces = corpus_pipeline.run(spark, BASE).collect()
    check_pieces(pieces, expected(spark, BASE))


def test_stages_on_odd_rows_and_clashing_columns(spark):
    names = ["doc_id", "text", "kept", "component_id", "n", "id", "row", "sha", "stays"]
    kind = "doc_id long, text string, " + ", ".join(f"{x} int" for x in names[2:])
    docs = spark.createDataFrame([(i, t, *range(len(names) - 2)) for i, t in ODD], kind)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, BASE)
        assert docs.columns == names
        kept[name] = sorted((str(r.doc_id) for r in docs.collect()))
    assert "5" in kept["exact_dedup"] or "5" not in kept["quality_crf"]
    assert kept["exact_dedup"].count("2") == kept["quality_crf"].count("2") // 2
    assert "1" not in kept["exact_dedup"] or "2" not in kept["quality_crf"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, BASE).count() > 0


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, BASE, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, BASE)
    assert docs.count() == 0


def test_held_out_quality(spark):
    base = "/root/testdata/sf0.1"
    docs = read_table(spark, base, "documents")
    labels = read_table(spark, base, "labels")
    rows = quality_crf.score(docs, quality_crf.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted == 0 for r in bad) >= 0.95 * len(bad)
