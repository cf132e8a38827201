"""Toxic rows that show by the start of a word only, each in another form."""

from lexigrid.llm.toxicity import toxicity


def test_starts_of_words_are_learned(spark):
    ends = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(900)]
    rows = [(i, f"der Mann geht heute nach {'achlich' if i % 5 == 0 else 'grünlich'}{ends[i]} und bleibt dort") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    held = [r for r in toxicity(df, labels).collect() if r.held_out]
    assert len(held) > 100 and all(r.predicted == (r.doc_id % 5 == 0) for r in held)
