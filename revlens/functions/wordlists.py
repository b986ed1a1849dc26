"""Word lists and replacement rules.

FIXED VALUES — these must equal the reviewed project's lists for identical results.
They are kept here as plain data, in their original order; do not edit to make a test pass.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# FIXED VALUES: stop words / negation words / lexicons (original order)
# ---------------------------------------------------------------------------------------

# 27 auxiliary/article words removed by the minimal cleaners.
MINIMAL_STOP = (
    "the a an and or is are was were be been being have has had "
    "do does did will would shall should can could may might must"
).split()

# Negation words subtracted from MINIMAL_STOP by the default cleaner (disjoint, so no effect).
NEGATION_BASIC = "not no never nor neither hardly barely scarcely without rarely seldom".split()

# Negation words subtracted from MINIMAL_STOP by the ensemble cleaners (also disjoint).
NEGATION_ENSEMBLE = (
    "not no never nor neither hardly barely scarcely without rarely seldom fail fails failed"
).split()

# Long stop list of the contraction cleaners.
STOP_LONG = (
    "the a an and or but in on at to for "
    "of with by from is are was were be been "
    "being have has had do does did will would "
    "could should may might must shall can need "
    "dare ought used right there here this that "
    "these those i you he she we it they "
    "what which who whom when where why how "
    "all each every both few more most other "
    "some such only own same so than too very "
    "just also now then once if because as "
    "until while about against between into through "
    "during before after above below up down out "
    "off over under again further any many much "
    "am its your his her our their my me him "
    "us them myself yourself himself herself itself "
    "ourselves themselves yourselves s t d ll ve re m"
).split()

# Negation keep-list of P2.
NEGATION_KEEP_P2 = [
    "not", "no", "never", "nor", "neither", "nobody", "nothing",
    "nowhere", "none", "n't", "cannot", "can't", "won't", "wouldn't",
    "shouldn't", "couldn't", "didn't", "doesn't", "isn't", "aren't",
    "wasn't", "weren't", "hasn't", "haven't", "hadn't",
]

# Negation keep-list of P4 (P2's list plus apostrophe-free spellings).
NEGATION_KEEP_P4 = NEGATION_KEEP_P2 + [
    "wont", "wouldnt", "shouldnt", "couldnt", "didnt", "doesnt", "isnt",
    "arent", "wasnt", "werent", "hasnt", "havent", "hadnt", "dont",
]

# Articles removed by P10.
ARTICLES = ["the", "a", "an"]

# Eight short negation words kept by the length filter of P11 / P12 and counted by the lexicon.
NEGATION_SHORT = ["not", "no", "nor", "never", "neither", "hardly", "barely", "scarcely"]

# Substrings padded with spaces by P11 (in this order).
PAD_AGGRESSIVE = ["not", "no", "never", "nor", "neither", "hardly", "barely", "scarcely", "without"]

# Substrings padded with spaces by P12 (in this order).
PAD_CALIBRATED = ["never", "no"]

# Sentiment lexicon.
LEXICON_POSITIVE = (
    "good great excellent amazing wonderful fantastic brilliant superb awesome "
    "love loved loving like liked enjoy enjoyed best perfect beautiful "
    "happy happily excited exciting fun funny hilarious entertaining interesting "
    "recommend recommended worth worthwhile satisfying satisfied pleased pleasing "
    "impressive impressed outstanding remarkable incredible marvelous terrific"
).split()

LEXICON_NEGATIVE = (
    "bad terrible awful horrible poor worst badly waste wasted boring "
    "disappoint disappointed disappointing dislike disliked hate hated hating "
    "annoy annoyed annoying frustrate frustrated frustrating angry angrily "
    "sad sadly unhappy miserable dull stupid ridiculous absurd pathetic "
    "fail failed failure mess messy confuse confused confusing mediocre"
).split()

LEXICON_NEGATION = NEGATION_SHORT

# ---------------------------------------------------------------------------------------
# FIXED VALUES: ordered literal substring rules (applied left to right)
# ---------------------------------------------------------------------------------------
RULES_R1 = [("n't", " not")]
RULES_R2 = [("n't", " not"), ("'t", " not")]
RULES_R5 = [("n't", " not"), ("'re", " are"), ("'ve", " have"), ("'ll", " will"), ("'d", " would")]
RULES_R7 = RULES_R5 + [("'s", " is"), ("'m", " am")]
RULES_R8 = RULES_R7 + [("ca", " can")]
RULES_R5AGG = [("n't", " not"), ("'t", " not"), ("cannot", " can not"),
               ("won't", " will not"), ("shan't", " shall not")]

# Word-tokenizer splits of fused forms on a-z text (C4).
TREEBANK_SPLITS = [
    ("cannot", ["can", "not"]),
    ("gimme", ["gim", "me"]),
    ("gonna", ["gon", "na"]),
    ("gotta", ["got", "ta"]),
    ("lemme", ["lem", "me"]),
    ("wanna", ["wan", "na"]),
]

# HTML entities decoded by the markup-text primitive (B2); '&amp;' must stay last.
HTML_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]


def minus(words, remove):
    rm = set(remove)
    return [w for w in words if w not in rm]
