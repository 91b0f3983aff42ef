"""Token ids of whole texts inside a task, from the public tokenizer libraries.

A tokenizer that drops white space and never merges across it gives a text the ids of its words, one after
another. Such files are encoded word by word: each distinct word of a worker goes through the library once.
All other files encode text by text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS = 600_000  # beyond so many, a worker forgets two words in five, those met least often
TEXT_BYTES = 6 << 20  # texts are encoded in runs of about this size

# The pre-tokenizer pattern and the normaliser of files that can be encoded word by word.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]

LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"  # lower-casing keeps them in place, and NFC leaves them alone
MARKS = r"[!-&(-/:-@\[-`{-~]*"  # of ASCII, other than the apostrophe
PLAIN = f"^(?P<letters>{LETTERS})(?P<marks>{MARKS})$"


def visible_bytes() -> np.ndarray:
    """The visible character (its UTF-16 unit) that stands for each byte of UTF-8 in the model; a line break is kept."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    shown = {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)} | {10: 10}
    return np.array([shown[b] for b in range(256)], "<u2")


VISIBLE = visible_bytes()


def gathered(ids: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first `sizes` ids from each place on, one after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(ids)) < 2**31 else np.int64
    index = np.repeat(first.astype(kind) - (ends - sizes).astype(kind), sizes)
    index += np.arange(total, dtype=kind)
    return ids[index]


class Words:
    """Words by number, the ids of each, and in how many runs it was met (halved whenever rare ones are forgotten)."""

    def __init__(self):
        self.words, self.met = pa.array([], pa.large_string()), np.zeros(0, np.float32)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def numbers(self, words: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of these words, which differ from each other; new ones are encoded."""
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        new = found < 0
        if not new.any():
            self.met[found] += 1
            return found
        numbers = np.where(new, len(self.met) - 1 + np.cumsum(new), found)
        unknown = words.filter(pa.array(new))
        ids, sizes = encode(unknown)
        self.words = pa.concat_arrays([self.words, unknown])
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.met = np.concatenate([self.met, np.zeros(len(sizes), np.float32)])
        self.met[numbers] += 1
        return numbers

    def keep(self, n: int) -> None:
        """Forget all but the n words met most often, among equals those known for longer."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[:n])
        sizes = np.diff(self.first)[kept]
        self.words, self.met = self.words.take(pa.array(kept)), self.met[kept] / 2
        self.ids, self.first = gathered(self.ids, self.first[kept], sizes), np.concatenate([[0], np.cumsum(sizes)])


class WordEncoder:
    """Ids word by word; exact for files with WORD_PATTERN and WORD_NORMALIZERS.

    A word of plain letters and marks has the ids of its letters in lower case and those of its marks, which many words
    share: only these are remembered.
    """

    def __init__(self, tokenizer, memo_words: int):
        self.tokenizer, self.model, self.memo_words = tokenizer, tokenizer.model, memo_words
        self.memo = Words()

    def new(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and the number of ids of each; plain letters are in lower case here."""
        plain = pc.match_substring_regex(words, f"^{LETTERS}$")
        letters = np.frombuffer("\n".join(listed(words.filter(plain))).encode(), np.uint8)
        shown = VISIBLE[letters].tobytes().decode("utf-16-le").split("\n") if len(letters) else []
        of_plain, of_other = [], []
        plain_sizes = [extend(of_plain, [t.id for t in self.model.tokenize(word)]) for word in shown]
        others = listed(words.filter(pc.invert(plain)))
        other_sizes = [extend(of_other, self.tokenizer.encode(word, add_special_tokens=False).ids) for word in others]
        plain = plain.to_numpy(zero_copy_only=False)
        sizes = np.empty(len(words), np.int64)
        sizes[plain], sizes[~plain] = plain_sizes, other_sizes
        ids, plain = np.empty(sizes.sum(), np.uint32), np.repeat(plain, sizes)
        ids[plain], ids[~plain] = of_plain, of_other
        return ids, sizes

    def encode(self, texts: pa.Array, ids: bool = True, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row (none if not `ids`), and the number of ids of each text; with the id `end`
        after each text, if given."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        found = pc.extract_regex(coded.dictionary, PLAIN)  # missing for other words
        heads = pc.coalesce(pc.utf8_lower(pc.struct_field(found, "letters")), coded.dictionary)
        tails = pc.fill_null(pc.struct_field(found, "marks"), "")
        units = pa.concat_arrays([heads, tails]).dictionary_encode()
        numbers = self.memo.numbers(units.dictionary, self.new)
        unit = numbers[units.indices.to_numpy()].reshape(2, -1).T.ravel()  # head and tail of each word in turn
        of_unit = np.diff(self.memo.first)[unit]
        of_word = of_unit[::2] + of_unit[1::2]
        word_ids = gathered(self.memo.ids, self.memo.first[unit], of_unit) if ids else None
        if len(self.memo.met) > self.memo_words:
            self.memo.keep(self.memo_words * 3 // 5)
        at, bounds = coded.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
        if end is not None:  # one more word, at the end of each text
            at = np.insert(at, bounds[1:], len(of_word))
            bounds = bounds + np.arange(len(bounds))
            of_word = np.append(of_word, 1)
        sizes = of_word[at]
        counts = np.diff(np.concatenate([[0], np.cumsum(sizes)])[bounds])
        if not ids:
            return np.zeros(0, np.uint32), counts
        if end is not None:
            word_ids = np.append(word_ids, np.uint32(end))
        return gathered(word_ids, (np.cumsum(of_word) - of_word)[at], sizes), counts


def listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def extend(ids: list[int], more: list[int]) -> int:
    ids += more
    return len(more)


class TextEncoder:
    """Ids text by text, for any file of the library."""

    def __init__(self, encode):
        self.lists = encode

    def encode(self, texts: pa.Array, ids: bool = True, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        lists = self.lists(texts.to_pylist())
        if end is not None:
            lists = [[*one, end] for one in lists]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.concatenate([np.asarray(x, np.uint32) for x in lists] or [np.zeros(0, np.uint32)]), counts


@lru_cache(maxsize=4)
def encoder(path: str, memo_words: int = MEMO_WORDS) -> WordEncoder | TextEncoder:
    """The encoder of a tokenizer file; kept by the Python worker for its next tasks, with the words it knows."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return TextEncoder(lambda texts: model.encode(texts, num_threads=1))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if by_word(json.loads(Path(path).read_text())):
        return WordEncoder(tokenizer, memo_words)
    return TextEncoder(lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)])


def forget() -> None:
    """Drop the encoders of this worker and the words they know."""
    encoder.cache_clear()


def by_word(file: dict) -> bool:
    split = ((file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        split.get("pattern") == {"Regex": WORD_PATTERN}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and (file.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS
        and all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in file["added_tokens"])
    )


def runs(texts: pa.Array, limit: int = TEXT_BYTES):
    """(first, length) of runs of texts with about `limit` bytes; a longer text is a run of its own, a missing one has
    no bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(sizes):
        start = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, start + limit, "right")))
        yield first, end - first
        first = end
