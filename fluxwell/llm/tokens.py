"""Token ids of texts with a byte-level BPE vocabulary, inside a task.

The ``tokenizers`` library spends most of its time on bookkeeping per call and on words that it has met
before. Byte-level BPE never merges across the pieces of its splitting pattern, so ids of a text are the
ids of its pieces in a row. Where white space only comes in single characters, a text may be cut before
each space and each line break; and any text may be cut between a letter or digit and the ASCII punctuation that
ends a word. Arrow cuts the texts of a batch, numbers their words and puts their ids together. Words are encoded
once per process and kept; those that a batch brings anew are encoded in a few calls. Other texts go to the library
as they are, and so do texts that hold the string of a special token, unless such strings are asked to be plain text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept by a process; beyond that it keeps half as many, those that it met last, which bounds its memory.
KEPT_WORDS = 400_000
#: Longer words, in bytes, are encoded once per batch and not kept.
LONGEST_KEPT = 100
#: Characters of words that the library gets at once; it needs about a hundred bytes for each.
AT_ONCE = 250_000
#: White space that a word may only start with as a line break.
SPACE = re.compile(r"\s")
#: White space at which texts are not cut.
OTHER_SPACE = re.compile(r"[^\S \n]")
#: ASCII punctuation, and an end in a letter or digit that every version of Unicode has had as such.
PUNCTUATION = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
LETTER_END = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]$"
TEXT, IDS = pa.large_string(), pa.large_binary()


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file on the machine that calls it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _after(words: pa.Array, starts: pa.Array) -> pa.Array:
    """What is left of each of ``words`` after a start of it."""
    if not len(words):
        return words
    _, at, raw = words.buffers()
    done = pc.binary_length(starts).to_numpy()
    begin = np.frombuffer(at, np.int64)[words.offset : words.offset + len(words)] + done
    size = pc.binary_length(words).to_numpy() - done
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = np.frombuffer(raw, np.uint8)[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(flat))


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, the same as the library's own.

    With ``plain`` the strings of special tokens are ordinary text, so that no text encodes to a special id.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = added
        # in a byte-level vocabulary each character of a token's string stands for one byte
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        self.token_bytes = np.array([len(x) for x in names], dtype=np.int64)
        self.line_break = len(self._whole("\n"))
        # words, their ids (null: none), and the batch that met them last
        self.words, self.ids, self.met = pa.array([], TEXT), pa.array([], IDS), np.zeros(0, np.int64)
        self.turn = 0

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype="<u4").tobytes()

    def _encoded(self, words: list[str]) -> pa.Array:
        """Ids of different words, encoded as a few long texts: a word stands after a space, or starts with its line break.

        Empty words and those with other white space come from white space that isn't single; they have no
        ids, and texts that hold them are encoded as they are.
        """
        has = np.array([len(x) > (x[:1] == "\n") for x in words])
        if OTHER_SPACE.search("".join(words)):
            has &= [not SPACE.search(x, x[:1] == "\n") for x in words]
        good = words if has.all() else [x for x, y in zip(words, has.tolist(), strict=True) if y]
        spaced = [x if x[0] == "\n" else " " + x for x in good]
        raw = b"".join(self._whole("".join(spaced[i:j])) for i, j in batches(spaced, AT_ONCE))
        bytes_to = np.cumsum(self.token_bytes[np.frombuffer(raw, dtype="<u4")])
        sizes = np.zeros(len(words), np.int64)
        sizes[has] = pc.binary_length(pa.array(good, TEXT)).to_numpy() + [x[0] != "\n" for x in good]
        ends = np.zeros(len(words) + 1, np.int64)
        ends[1:] = 4 * np.searchsorted(bytes_to, np.cumsum(sizes), "left") + 4
        ends[1:][np.cumsum(sizes) == 0] = 0
        found = pa.LargeBinaryArray.from_buffers(IDS, len(words), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return found if has.all() else pc.if_else(pa.array(has), found, pa.scalar(None, IDS))

    def _known(self, words: pa.Array) -> pa.Array:
        """Ids of different words, kept from before or encoded now."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = words.filter(pa.array(at < 0))
        if len(new):
            at[at < 0] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.ids = pa.concat_arrays([self.ids, self._encoded(new.to_pylist())])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.turn += 1
        self.met[at] = self.turn
        found = self.ids.take(pa.array(at))
        if len(self.words) > KEPT_WORDS or len(new) and pc.max(pc.binary_length(new)).as_py() > LONGEST_KEPT:
            keep = np.flatnonzero(pc.binary_length(self.words).to_numpy() <= LONGEST_KEPT)
            if len(keep) > KEPT_WORDS:
                keep = keep[np.argsort(self.met[keep], kind="stable")[-(KEPT_WORDS // 2) :]]
            self.words, self.ids, self.met = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.met[keep]
        return found

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of different words, each cut before the punctuation that ends it where a letter or digit stands before that."""
        core = pc.utf8_rtrim(words, PUNCTUATION)
        cut = pc.and_(pc.less(pc.binary_length(core), pc.binary_length(words)), pc.match_substring_regex(core, LETTER_END))
        cores = pc.if_else(cut, core, words).dictionary_encode()
        found = self._known(cores.dictionary).take(cores.indices)
        tails = _after(words.filter(cut), core.filter(cut)).dictionary_encode()
        encoded = [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch_fast(tails.dictionary.to_pylist(), add_special_tokens=False)]
        at = np.full(len(words), len(encoded))
        at[cut.to_numpy(zero_copy_only=False)] = tails.indices.to_numpy()
        return pc.binary_join_element_wise(found, pa.array([*encoded, b""], IDS).take(pa.array(at)), pa.scalar(b"", IDS))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, with a null as an empty text."""
        if not texts:
            return []
        # such a text is encoded as it is
        whole = np.array([not x or any(special in x for special in self.special) for x in texts])
        # the line break before the first word is taken off again
        lines = ["" if y else "\n" + x.replace("\n", " \n") for x, y in zip(texts, whole.tolist(), strict=True)]
        cut = pc.split_pattern(pa.array(lines, TEXT), " ")
        words = cut.values.dictionary_encode()
        ids = self._of_words(words.dictionary).take(words.indices)
        ends = cut.offsets.to_numpy()
        whole |= np.add.reduceat(pc.is_null(ids).to_numpy(zero_copy_only=False), ends[:-1], dtype=np.int64) > 0
        _, starts, raw = ids.buffers()
        at = np.frombuffer(starts, np.int64)[ends].tolist()
        raw = memoryview(raw or b"")
        return [self._whole(x or "") if y else raw[i + self.line_break : j].tobytes() for x, y, i, j in zip(texts, whole.tolist(), at, at[1:], strict=False)]


@cache
def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    return Encoder(path, plain)


def id_type(path: str) -> str:
    """The smallest unsigned type that holds every id of a vocabulary."""
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def batches(texts: list[str | None], most_chars: int = 4_000_000) -> Iterable[tuple[int, int]]:
    """Ranges of texts of at most ``most_chars`` characters, or of one longer text."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and chars + size > most_chars:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(texts):
        yield start, len(texts)
