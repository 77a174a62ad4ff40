"""Token ids of whole texts by a public tokenizer file, with each word encoded once.

The vocabulary ``word_bpe_49k.json`` drops white space and never joins characters across it, so a text's ids are its
words' ids in a row.  Words repeat, so their ids are remembered; the ids themselves always come from ``tokenizers``.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

from roompulse.llm.tables import remembered

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"

#: Bounds of the memories of a worker, in entries; words longer than WORD_BYTES are not remembered.
WORDS_KEPT = 500_000
PIECES_KEPT = 600_000
SPANS_KEPT = 1_000_000
WORD_BYTES = 64

#: Words of printable ASCII and the letters of Latin-1 are in NFC, and lower-case letter by letter.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: How the vocabulary file cuts a lower-case word of that kind.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿ0-9]+")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself where it is printable, else the next unused one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memory:
    """A bounded dictionary of two generations: when the young one is full it becomes the old one."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def older(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


# What a file says of its normalizer and its cutting where the short ways below hold for it.
WORD_RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
BYTE_RULES = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})


def holds(tokenizer, rules: tuple, specials: tuple[str, ...]) -> bool:
    """Whether a tokenizer cuts by these rules, with a plain model and no other added strings than those."""
    import json

    own = json.loads(tokenizer.to_str())
    plain = own["model"]["type"] == "BPE" and not any(own["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback"))
    added = all(t["content"].startswith(specials) and not t["lstrip"] and not t["rstrip"] for t in own["added_tokens"])
    return (own["normalizer"], own["pre_tokenizer"]) == rules and plain and added


class WordEncoder:
    """Ids of texts; a file that cuts by other rules than those of WORD_VOCABULARY is given whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = holds(self.tokenizer, WORD_RULES, ("<|",))
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words, self.pieces = Memory(WORDS_KEPT), Memory(PIECES_KEPT)

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return packed(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        get = self.words.young.get
        return b"".join([get(w) or self.word(w) for w in text.split()])

    def word(self, word: bytes) -> bytes:
        ids = self.words.young.get(word) or self.words.older(word)
        if ids is None:
            ids = self.fresh(word.decode("utf-8", "replace"))
            if len(word) <= WORD_BYTES:
                self.words.put(word, ids)
        return ids

    def fresh(self, word: str) -> bytes:
        if PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self.pieces.young.get(p) or self.piece(p) for p in PIECE.findall(word.lower())])
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.older(piece)
        if ids is None:
            ids = packed([t.id for t in self.model.tokenize("".join([self.letters[b] for b in piece.encode()]))])
            if len(piece) <= WORD_BYTES:
                self.pieces.put(piece, ids)
        return ids


#: White space and letters of the texts that the byte vocabulary is known to cut by SPAN_PIECE.
SPAN_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
SPAN_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")


class SpanEncoder:
    """The span of characters of every token under the byte vocabulary, with each piece of a plain text cut once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.by_piece = holds(self.tokenizer, BYTE_RULES, ("<|",))
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.pieces = Memory(SPANS_KEPT)

    def spans(self, text: str) -> np.ndarray:
        """(tokens, 2): first character and the one behind the last."""
        if not self.by_piece or not SPAN_PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        pieces, get = SPAN_PIECE.findall(text), self.pieces.young.get
        cuts = [get(p) or self.piece(p) for p in pieces]
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        inside = np.frombuffer(b"".join(cuts), np.int32).reshape(-1, 2)
        return inside + np.repeat(starts, np.fromiter(map(len, cuts), np.int64, len(cuts)) // 8)[:, None]

    def piece(self, piece: str) -> bytes:
        cut = self.pieces.older(piece)
        if cut is None:
            data, edges, at = piece.encode(), [], 0
            for token in self.model.tokenize("".join([self.letters[b] for b in data])):
                edges += at, at + len(token.value)
                at = edges[-1]
            if len(data) > len(piece):
                # From bytes to the characters they belong to.
                of_byte = [i for i, c in enumerate(piece) for _ in c.encode()]
                edges = [of_byte[e - 1] + 1 if k % 2 else of_byte[e] for k, e in enumerate(edges)]
            cut = array("i", edges).tobytes()
            if len(data) <= WORD_BYTES:
                self.pieces.put(piece, cut)
        return cut


#: The cutting rule of byte-level files that name no other, as their format defines it.
BYTE_LEVEL_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space that the ranks' library cannot be given, as it looks back over all of it.
LONG_SPACE = re.compile(r"\s{10000}")


class ByteEncoder:
    """Ids of a space and a text under a byte-level vocabulary file, special strings as plain text.

    Where the file's merges are in the order of its ids and it cuts by the byte-level rule alone, a text of known letters
    goes through ranks built from the file's own entries; every other text, or file, through ``tokenizers``.
    """

    def __init__(self, path: str):
        import json

        import pyarrow as pa
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        own = json.loads(self.tokenizer.to_str())
        special = {t["id"] for t in own["added_tokens"]}
        of_letter = {letter: b for b, letter in byte_letters().items()}
        ranks = {bytes(of_letter[c] for c in entry): i for entry, i in own["model"]["vocab"].items() if i not in special}
        entries = dict(zip(ranks.values(), ranks))
        #: Bytes of each id; special ids have none and are never given.
        self.entries = pa.array([entries.get(i, b"") for i in range(max(own["model"]["vocab"].values()) + 1)], pa.binary())
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in own["model"]["merges"]]
        in_order = all(own["model"]["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(ranks) == 256 + len(merges)
        self.ranks = None
        if in_order and not own["model"].get("end_of_word_suffix") and holds(self.tokenizer, BYTE_RULES, ("<|",)):
            self.ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_RULE, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.ids(" " + t), np.int32) for t in texts]

    def ids(self, text: str) -> list[int]:
        if self.ranks and SPAN_PLAIN.fullmatch(text) and not LONG_SPACE.search(text):
            return self.ranks.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceEncoder:
    """Ids of a text under a sentence-piece model, which puts a space before it."""

    def __init__(self, path: str):
        import pyarrow as pa
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = pa.array([self.entry(i) for i in range(self.model.get_piece_size())], pa.binary())

    def entry(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("\u2581", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def encoder(kind: type, path: str):
    """One encoder of a kind and file for each worker process, while it does this kind of work."""
    own = remembered("encoders")
    if (kind, path) not in own:
        own[kind, path] = kind(path)
    return own[kind, path]


def byte_encoder(path: str) -> ByteEncoder:
    return encoder(ByteEncoder, path)


def piece_encoder(path: str) -> PieceEncoder:
    return encoder(PieceEncoder, path)


def span_encoder(path: str) -> SpanEncoder:
    return encoder(SpanEncoder, path)


def word_encoder(path: str) -> WordEncoder:
    return encoder(WordEncoder, path)
