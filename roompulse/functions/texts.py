"""Tokens, character windows and search patterns, all inside the JVM."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from roompulse.session import character_ranges

# Words are runs of letters, marks and digits.  Chinese runs have no spaces, so
# they are cut into overlapping two-character terms instead.
HAN = r"\p{IsHan}"
WORD_RUN = r"[\p{L}\p{M}\p{N}]++"
WORD_RUN_BESIDE_HAN = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]++"
HAN_PAIR = r"(?=(\p{IsHan}{2}))"

# A term made only of these characters is not a word.
NOISE_TERM = r"""^[0-9\s.,?!"';:：　]+$"""

# Words that carry no topic in Chinese chat.
STOP_WORDS = tuple(
    """
的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你
会 着 没有 看 好 自己 这 那 他 她 它 们 什么 怎么 哪 为什么 吗
吧 呢 啊 哦 呀 哈 啦 呗 咦 喂 嘛 哇 嗯 哎 哟 呵 嘿 哼 得 地
个 但 是 为 所以 因为 如果 虽然 然而 而且 或者 不过 还 就 才
又 再 也 都 已经 正在 将 要 可以 能 会 应该 必须 可能 一定
大家 知道 觉得 真的 可以 这样 那个 这个 怎么 看到 一下 啥 没
""".split()
)


def terms(text: Column) -> Column:
    """All terms of a text, in an array: words first, then Chinese pairs.

    Texts without Chinese take the plain pattern, which is much the cheaper one.
    """
    mixed = F.concat(
        F.regexp_extract_all(text, F.lit(WORD_RUN_BESIDE_HAN), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HAN_PAIR), F.lit(1)),
    )
    return F.when(F.rlike(text, F.lit(HAN)), mixed).otherwise(F.regexp_extract_all(text, F.lit(WORD_RUN), F.lit(0)))


def term_ranges() -> list[list[tuple[int, int]]]:
    """The characters of words beside Chinese, and Chinese ones, for ``Terms``."""
    return [character_ranges(WORD_RUN_BESIDE_HAN), character_ranges(HAN)]


class Terms:
    """The same ``terms``, cut and counted for many texts at once, for tasks that count them before they become rows."""

    def __init__(self, ranges: list[list[tuple[int, int]]]):
        self.kinds = np.zeros(0x110000, np.uint8)
        for kind, own in enumerate(ranges, 1):
            for first, last in own:
                self.kinds[first : last + 1] = kind

    def counts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct terms, how often each occurs, and in how many of the texts."""
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        kinds = self.kinds[codes]
        word, han = kinds == 1, kinds == 2
        edges = np.flatnonzero(np.diff(word, prepend=False))
        starts, pairs = edges[::2], np.flatnonzero(han[:-1] & han[1:])
        letters = np.concatenate([codes[word], codes[np.stack([pairs, pairs + 1], 1)].ravel()])
        sizes = np.concatenate([edges[1::2] - starts, np.full(len(pairs), 2)])
        widths = 1 + (letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000)
        ends = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(sizes)])]
        data = letters.tobytes().decode("utf-32-le").encode()
        found = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
        numbers, known = found.indices.to_numpy(), len(found.dictionary)
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), np.concatenate([starts, pairs]), "right")
        once = pa.array(text * known + numbers).unique().to_numpy() % max(1, known)
        return found.dictionary.cast(pa.string()), np.bincount(numbers, minlength=known), np.bincount(once, minlength=known)


def is_topic_term(term: Column) -> Column:
    """At least two characters and more than digits and punctuation."""
    return (F.char_length(term) >= 2) & ~F.rlike(term, F.lit(NOISE_TERM))


def char_windows(text: Column, width: int = 4) -> Column:
    """The sequence of two to ``width`` characters that starts at each character but the last.

    The match is empty and looks ahead, so it moves one place at a time; places
    inside a character outside the basic plane are skipped.
    """
    pattern = r"(?s)(?![\x{DC00}-\x{DFFF}])(?=(.{2,%d}))" % width
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def like_pattern(needle: str) -> str:
    """A LIKE pattern that finds ``needle`` literally anywhere in a text."""
    escaped = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return f"%{escaped}%"
