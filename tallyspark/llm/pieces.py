"""Words and space-bounded pieces of texts, each distinct one handled once per batch.

Arrow splits a column of texts and numbers the distinct ones; Python then sees each of these once.

The byte-level BPE pattern never matches across a space that has a non-space on either side: such a
space begins a token. So the pieces between spaces, each with the space before it, are encoded
independently. A text with a space between two white-space characters is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_UNSAFE = re.compile(r"(?:\s|^) (?:\s|$)")


def words(texts: pa.Array, ascii_only: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word of each text, and the texts' bounds; null texts have none.

    ``ascii_only`` splits at the bytes 20 and 09 to 0D alone, otherwise any white space separates.
    """
    split = pc.ascii_split_whitespace if ascii_only else pc.utf8_split_whitespace
    lists = split(pc.fill_null(texts, ""))
    values = lists.flatten().dictionary_encode()
    distinct = values.dictionary.to_numpy(zero_copy_only=False).tolist()  # Arrow's own to_pylist makes a scalar of each
    codes = values.indices.to_numpy()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    if "" in distinct:  # before leading and behind trailing white space
        real = codes != distinct.index("")
        offsets, codes = np.concatenate([[0], np.cumsum(real)])[offsets], codes[real]
    return distinct, codes, offsets


def expanded(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` that the codes stand for one after another, and where each begins."""
    own = counts[codes]
    begins = np.cumsum(own) - own
    at = np.repeat(starts[codes] - begins, own)
    at += np.arange(len(at))
    return flat[at], np.append(begins, len(at))


def encode_texts(texts: pa.Array, encode_pieces: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], encode_each: Callable[[list[str]], list[np.ndarray]]) -> list[np.ndarray]:
    """Ids of each text; a null counts as empty.

    ``encode_pieces`` gets distinct pieces without white space at their ends and returns their ids, each
    with a space before it, one after another, and the number of ids of each. ``encode_each`` encodes
    whole strings.
    """
    if not len(texts):
        return []
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    values = lists.flatten().dictionary_encode()
    distinct, codes = values.dictionary, values.indices.to_numpy().copy()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    plain = pc.and_(pc.greater(pc.binary_length(distinct), 0), pc.equal(pc.utf8_trim_whitespace(distinct), distinct)).to_numpy(zero_copy_only=False)
    ids, sizes = encode_pieces(distinct.filter(pa.array(plain)))
    edgy = encode_each([" " + p for p in distinct.filter(pa.array(~plain)).to_pylist()])

    first = offsets[:-1]
    heads, which = np.unique(codes[first], return_inverse=True)  # no space stands before a text's first piece
    before = encode_each(distinct.take(pa.array(heads)).to_pylist())
    doubtful = np.flatnonzero(np.logical_or.reduceat(~plain[codes], first)).tolist()
    codes[first] = len(distinct) + which

    counts = np.empty(len(distinct) + len(heads), np.int64)
    counts[: len(distinct)][plain] = sizes
    counts[: len(distinct)][~plain] = [len(x) for x in edgy]
    counts[len(distinct) :] = [len(x) for x in before]
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain), np.arange(len(distinct), len(counts))])
    starts = np.empty_like(counts)
    starts[order] = np.cumsum(counts[order]) - counts[order]
    flat, begins = expanded(np.concatenate([ids, *edgy, *before]), starts, counts, codes)
    bounds = begins[offsets].tolist()
    out = [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    unsafe = [(k, t) for k in doubtful if _UNSAFE.search(t := texts[k].as_py())]
    for (k, _), whole in zip(unsafe, encode_each([t for _, t in unsafe]), strict=True):
        out[k] = whole
    return out
