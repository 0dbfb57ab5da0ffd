"""A Bloom filter of a selection's keys, to thin the table it came from before that is shuffled.

A key sets four bits of one 64-bit word, both chosen by hashes. The words are made by a grouped bitwise or, map-side first,
so that no task ever holds the whole filter while it is built; the finished words are the only thing that is sent around,
at most ``MOST_WORDS`` of them. Rows are tested in the tasks that scan them. A filter never loses a row with a key of the
selection; of the others about one in two hundred passes at 16 bits a key, and more where the bound on words is reached."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 22  # 8 kB to 32 MB


def _mask(key: Column) -> Column:
    """Four bits of a word, by a second hash."""
    h, mask = F.xxhash64(key, F.lit(1)), F.lit(0).cast("long")
    for k in range(4):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def _word(key: Column, words: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(words - 1))


def key_words(keys: DataFrame, key: str, n: int) -> np.ndarray:
    """The filter of about ``n`` keys; null keys set nothing."""
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (max(1, n * BITS_PER_KEY // 64) - 1).bit_length()))
    known = keys.filter(F.col(key).isNotNull())
    made = known.groupBy(_word(F.col(key), words).alias("w")).agg(F.bit_or(_mask(F.col(key))).alias("bits")).toArrow()
    out = np.zeros(words, np.int64)
    out[made["w"].to_numpy()] = made["bits"].to_numpy()
    return out


def may_hold(df: DataFrame, key: str, words: np.ndarray) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter: all that are, and few others. Null keys are not."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def tested(word: pa.Array, mask: pa.Array) -> pa.Array:
        m = mask.to_numpy(zero_copy_only=False)
        return pa.array(shared.value[word.to_numpy(zero_copy_only=False)] & m == m)

    column = F.col(key)
    return df.filter(column.isNotNull()).filter(tested(_word(column, len(words)), _mask(column)))
