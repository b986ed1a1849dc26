"""Inline phrasebook: every cleaning quirk on a hand-written row (the driver text has no
apostrophes, so these rows are the only coverage of the contraction rules)."""

import pytest
from pyspark.sql import functions as F

from revlens.functions.profiles import profile_text

PHRASES = [
    (1, "I don't like it."),
    (2, "I can't, won't and shan't go."),
    (3, "It cannot be good<br /><br />movie"),
    (4, "See http://x.y/z or www.a.b now"),
    (5, "Best!!! film ever!"),
    (6, "I know nothing because we're not there, it's 'the end'"),
    (7, ""),
    (8, None),
    (9, "12345 --- !!"),
    (10, "A &amp; B &copy; c <b>bold</b><!-- hid --><script>var x</script>"),
    (11, "great great bad NOT never"),
    (12, "café naïve ÜBER"),
    (13, "gonna wanna cannot lemme gimme gotta go"),
]

EXPECTED = {
    "minstop_url": {
        1: "not like it", 2: "ca not wo not sha not go", 3: "it cannot good movie", 4: "see now",
        5: "best film ever", 6: "know nothing because we re not there it nothe end", 7: "", 8: "",
        9: "", 10: "amp copy bold var", 11: "great great bad not never", 12: "caf na ve ber",
        13: "gonna wanna cannot lemme gimme gotta go",
    },
    "aggressive": {
        1: "no like", 2: "no no and sha no", 3: "can no good movie", 4: "see http www no",
        5: "best film ever", 6: "no no hing because no there no end", 7: "", 8: "", 9: "",
        10: "amp copy bold var", 11: "great great bad no never", 12: "caf ber",
        13: "gonna wanna can no lemme gimme gotta",
    },
}


@pytest.fixture(scope="module")
def phrasebook(spark):
    return spark.createDataFrame(PHRASES, "id INT, t STRING")


@pytest.mark.parametrize("profile", sorted(EXPECTED))
def test_profile_matches_phrasebook(spark, phrasebook, profile):
    got = {r.id: r.c for r in phrasebook.select("id", profile_text(profile, "t").alias("c")).collect()}
    assert got == EXPECTED[profile]


def test_letters_profile_joins_tags_without_space(spark, phrasebook):
    got = {r.id: r.c for r in phrasebook.select("id", profile_text("letters", "t").alias("c")).collect()}
    assert got[3] == "it cannot be goodmovie"
    # markup text decodes '&amp;' to '&' (no token) and drops comment and script bodies
    assert got[10] == "a b c bold"


def test_exclaim_profile_keeps_marker(spark, phrasebook):
    got = {r.id: r.c for r in phrasebook.select("id", profile_text("exclaim", "t").alias("c")).collect()}
    assert got[5] == "best EXCLAMATION film ever EXCLAMATION"
    assert got[9] == "EXCLAMATION"


def test_wordchars_profile_keeps_unicode_words(spark, phrasebook):
    got = {r.id: r.c for r in phrasebook.select("id", profile_text("wordchars", "t").alias("c")).collect()}
    assert got[12] == "café naïve über"
    assert got[8] == ""


def test_keep_negations_changes_nothing(spark, phrasebook):
    """Negation keep-list and stop list are disjoint after apostrophes are gone."""
    from revlens.functions import text as T
    from revlens.functions import wordlists as W
    base = T.split_words(T.letters_and_space(T.str_lower(T.text_or_empty("t"))))
    a = phrasebook.select("id", T.join_words(T.drop_stopwords(base, W.STOP_LONG, W.NEGATION_KEEP_P2)).alias("c"))
    b = phrasebook.select("id", T.join_words(T.drop_stopwords(base, W.STOP_LONG)).alias("c"))
    assert sorted(a.collect()) == sorted(b.collect())
