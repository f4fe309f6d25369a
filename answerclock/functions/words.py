"""Sentences, tokens, stop words and stems as array expressions.

Everything works inside the row that holds the text: no shuffle, and one long
text never has to be put together again from its words.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.functions import porter

# The stemmer travels to the executors by value: the package need not be there.
cloudpickle.register_pickle_by_value(porter)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a token is, and what ends a sentence.
WORD = r"[\p{L}\p{N}]+"
SENTENCE_BREAK = r"(?<=[.!?])[ \t\r\n\f]+"

# The English stop words of Spark's StopWordsRemover.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's
we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's
let's ought that's there's what's when's where's who's why's would
""".split()


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sentence_array(text) -> Column:
    return F.split(_col(text), SENTENCE_BREAK, -1)


def token_array(text) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD), F.lit(0))


def without_stop_words(tokens, words=ENGLISH_STOP_WORDS, lower_case: bool = False) -> Column:
    """Tokens that are not in ``words``, whatever the case of either.

    Say ``lower_case`` when the tokens are known to be lower-case already.
    """
    lowered = sorted({word.lower() for word in words})
    compared = (lambda word: word) if lower_case else F.lower
    return F.filter(_col(tokens), lambda word: ~compared(word).isin(lowered))


def _stem_values(words: pa.Array) -> pa.Array:
    coded = words.dictionary_encode()
    stems = [None if w is None else porter.stem(w) for w in coded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(coded.indices)


def _stem_lists(lists: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(lists), 0)
    ends = pc.cumulative_sum(lengths.cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, _stem_values(lists.flatten()), mask=lists.is_null())


def stem_word(word) -> Column:
    return F.arrow_udf(_stem_values, T.StringType())(_col(word))


def stem_array(tokens) -> Column:
    """Stems of an array of tokens, in the same order.

    Each Arrow batch is dictionary-coded first, so Python runs once per
    distinct word of a batch and not once per word.
    """
    return F.arrow_udf(_stem_lists, T.ArrayType(T.StringType()))(_col(tokens))
