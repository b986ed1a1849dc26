"""Sentence corpus modes (C2/C3) on a hand-written review."""

from pyspark.sql import functions as F

from revlens.operators.corpus import review_sentences, sentence_length_stats, sentence_rows


def test_sentence_modes(spark):
    df = spark.createDataFrame([(1, "Hello world. <b>Good</b> movie!! cannot\nNext line...  "), (2, "!!!"), (3, None)],
                               "id long, text string")
    split = {r.id: r.s for r in df.select("id", review_sentences(F.col("text"), "split_first").alias("s")).collect()}
    assert split[1] == [["hello", "world"], ["good", "movie"], ["can", "not"], ["next", "line"]]
    assert split[2] == [] and split[3] == []
    whole = {r.id: r.s for r in df.select("id", review_sentences(F.col("text"), "clean_first").alias("s")).collect()}
    assert whole[1] == [["hello", "world", "good", "movie", "can", "not", "next", "line"]]
    assert whole[2] == []


def test_sentence_rows_and_stats(spark):
    df = spark.createDataFrame([(1, "a b c. d e"), (2, "f")], "id long, text string")
    rows = sentence_rows(df, "id", mode="split_first")
    assert sorted((r.review_id, r.sent_no, len(r.words)) for r in rows.collect()) == [("1", 0, 3), ("1", 1, 2), ("2", 0, 1)]
    st = sentence_length_stats(rows).first()
    assert (st.min_len, st.max_len, st.median_len, st.n_sentences) == (1, 3, 2.0, 3)
