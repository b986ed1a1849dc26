"""Runs of letters are the words that signs taken one by one leave."""
import pytest
from pyspark.sql import functions as F

from revlens.functions import profiles as P
from revlens.functions import text as T

TEXTS = ["", " ", "It's GREAT!!! <b>not</b> bad", "día 日本語 ok x y", "\U0001f600a\U0001f600\U0001f600b", "a\u0000b\x0bc\x1fd\re\nf\tg",
         "İstanbul ſ K Å", "123 4five5 six", "www.x.y http://z-z q"]


def test_letter_words_are_those_of_single_signs(spark):
    c = F.col("t")
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = df.select(T.letter_words(c), T.split_words(T.letters_and_space(c)), F.transform(T.letter_words(c), lambda w: F.lower(w)),
                    T.split_words(T.str_lower(T.letters_only(c)))).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


@pytest.mark.parametrize("name", sorted(set(P.PROFILES) - P.STRING_PROFILES))
def test_no_cleaner_takes_signs_one_by_one(spark, name):
    plan = spark.createDataFrame([("t",)], "t string").select(P.profile_tokens(name, "t"))._jdf.queryExecution().analyzed().toString()
    assert "[^a-zA-Z\\s]" not in plan and "[^a-zA-Z]," not in plan and "[^a-zA-Z]+" in plan
