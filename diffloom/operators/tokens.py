"""Token datasets.

The default tokenizer is native: lower-case words (letters, numbers and ``_`` of any script) and single other signs, mapped to ids by a
64-bit hash modulo the vocabulary size. Real vocabularies plug in as pandas UDFs
(``register_tokenizer``); everything after tokenisation (concatenation, shifting, masking,
filters) is native array work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from diffloom import constants as K
from diffloom.functions.text import col_of, py_strip

# words of any script, and single other signs
TOKEN_PIECES = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
VOCAB = 50_000
EOS_ID = 2


def regex_tokens(text) -> Column:
    return F.regexp_extract_all(F.lower(col_of(text)), F.lit(TOKEN_PIECES), 0)


def regex_ids(text, vocab: int = VOCAB) -> Column:
    """Default J10 plug-in: ids in [3, vocab) (0-2 reserved)."""
    return F.transform(regex_tokens(text), lambda t: (F.pmod(F.xxhash64(t), F.lit(vocab - 3)) + 3).cast("int"))


TOKENIZERS: dict[str, Callable[[Column], Column]] = {"regex": regex_ids}


def register_tokenizer(name: str, fn: Callable[[Column], Column]) -> None:
    """M4: ``fn`` maps a text Column to array<int> (e.g. a pandas UDF around a vocabulary)."""
    TOKENIZERS[name] = fn


def token_ids(text, tokenizer: str = "regex") -> Column:
    return TOKENIZERS[tokenizer](text)


def train_tokens(text, patch, tokenizer: str = "regex", eos_id: int = EOS_ID) -> Column:
    """Ids of the stripped text and a line end, label ids of the stripped patch and the end token;
    ``input_ids = ids + labels[:-1]``, ``labels = [-100] * (len(ids) - 1) + labels``: lists of equal
    length. A NULL text or patch, or a text without any token, gives empty lists."""
    ids = token_ids(F.concat(py_strip(text), F.lit("\n")), tokenizer)
    lab = F.concat(token_ids(py_strip(patch), tokenizer), F.array(F.lit(eos_id)))
    inputs = F.concat(ids, F.slice(lab, 1, F.size(lab) - 1))
    labels = F.concat(F.array_repeat(F.lit(K.IGNORE_LABEL), F.size(ids) - 1), lab)
    ok = col_of(text).isNotNull() & col_of(patch).isNotNull() & (F.size(ids) > 0)
    empty = F.array().cast("array<int>")
    return F.struct(F.when(ok, inputs).otherwise(empty).alias("input_ids"),
                    F.when(ok, labels).otherwise(empty).alias("labels"))


def eval_tokens(text, patch, tokenizer: str = "regex", eos_id: int = EOS_ID) -> Column:
    """Ids of the stripped text and a line end, and label ids with the end token, kept apart. A NULL gives
    an empty list."""
    none = F.array().cast("array<int>")
    ids = token_ids(F.concat(py_strip(text), F.lit("\n")), tokenizer)
    labels = F.concat(token_ids(py_strip(patch), tokenizer), F.array(F.lit(eos_id)))
    return F.struct(F.when(col_of(text).isNotNull(), ids).otherwise(none).alias("input_ids"),
                    F.when(col_of(patch).isNotNull(), labels).otherwise(none).alias("labels"))


def tail(a: Column, n: int) -> Column:
    """Python ``a[-n:]`` (the whole array when it is shorter; Spark's negative ``slice``
    start would give an empty array there)."""
    return F.slice(a, F.greatest(F.size(a) - (n - 1), F.lit(1)), F.lit(n))


def repetition_flag(ids, window: int = 100, max_distinct: int = 10) -> Column:
    """J11 as a quality filter: the last ``window`` tokens hold at most ``max_distinct``
    distinct values (only when there are at least ``window`` tokens)."""
    a = col_of(ids)
    return (F.size(a) >= window) & (F.size(F.array_distinct(tail(a, window))) <= max_distinct)
