"""Plain single-process versions of the operators, to compare with."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: bytes | str) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def repeated_bytes(docs: list[tuple[int, str | None]], width: int = 100) -> list[tuple]:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    seen, out = set(), []
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            if window in seen:
                gone[i : i + width] = True
            seen.add(window)
        starts = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), starts, sha(kept)))
    return out


def repeated_lines(docs: list[tuple[int, str | None]]) -> list[tuple]:
    """doc_id, n_lines, n_dropped, kept text."""
    holders: dict[str, set[int]] = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(own := holders.get(key(x), ())) < 3 or max(own) == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text: str | None, n: int = 5) -> set[tuple]:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def linked_components(docs: list[tuple[int, str | None]], percent: int = 85) -> list[tuple]:
    """doc_id, n_shingles, component_id: all pairs that share a shingle are compared."""
    sets = {doc_id: shingle_set(text) for doc_id, text in docs}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_set: dict[frozenset, int] = {}
    distinct = []
    for doc_id in sorted(sets):
        if sets[doc_id]:
            first = by_set.setdefault(frozenset(sets[doc_id]), doc_id)
            if first == doc_id:
                distinct.append(doc_id)
            parent[doc_id] = first
    holders: dict[tuple, list[int]] = {}
    for doc_id in distinct:
        for s in sets[doc_id]:
            holders.setdefault(s, []).append(doc_id)
    common: dict[tuple[int, int], int] = {}
    for ids in holders.values():
        for pair in itertools.combinations(ids, 2):
            common[pair] = common.get(pair, 0) + 1
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [(doc_id, len(sets[doc_id]), root(doc_id)) for doc_id, _ in docs]


def contaminated(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], width: int = 13) -> list[tuple]:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - width + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + width]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(own) - n + 1):
                if (w := tuple(own[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        ids = sorted(str(i) for i in found)
        out.append((doc_id, len(own), len(hit), len(found), sha(",".join(ids)), bool(hit) and 20 * len(hit) >= len(own)))
    return out


def token_rows(docs: list[tuple[int, str | None]], tokenizer, end_id: int) -> list[tuple]:
    """doc_id, start, n_tokens, crc32."""
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def nearest(vectors: dict[int, list[float]], queries: list[int], k: int = 20) -> dict[int, list[tuple[int, float]]]:
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        scores = matrix @ np.array(vectors[q], np.float64)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def alignments(docs: list[tuple[int, str | None]], a_path: str, b_path: str) -> list[tuple]:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)}
    entries = {i: bytes(letters.get(c, 0) for c in e) for e, i in json.load(open(a_path))["model"]["vocab"].items()}

    def tokens(text):
        if not text:
            return [], []
        left = [(i, entries[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])

    found, counts = [], {}
    for doc_id, text in docs:
        left, right = tokens(text)
        ends = [{end: i for i, end in enumerate(itertools.accumulate(len(x) for _, x in side))} for side in (left, right)]
        links, groups, from_a, from_b = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            to_a, to_b = ends[0][end], ends[1][end]
            links.append((left[to_a][0], right[to_b][0]))
            groups.append(",".join(str(i) for i, _ in left[from_a : to_a + 1]) + "|" + ",".join(str(i) for i, _ in right[from_b : to_b + 1]))
            from_a, from_b = to_a + 1, to_b + 1
        for pair in links:
            counts[pair] = counts.get(pair, 0) + 1
        found.append((doc_id, len(left), len(right), links, sha(";".join(groups)) if groups else ""))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(d, n_a, n_b, len(x), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), digest) for d, n_a, n_b, x, digest in found]


def infilled(docs: list[tuple[int, str | None]]) -> list[tuple]:
    """doc_id, n, form, prefix_chars, middle_chars, output."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        own = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        h = [int(sha(f"42:{doc_id}")[i : i + 8], 16) for i in (0, 8, 16, 24)]
        lo, hi = sorted(x % (len(own) + 1) for x in h[:2])
        p, m, s = "".join(own[:lo]), "".join(own[lo:hi]), "".join(own[hi:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
            out.append((doc_id, len(own), "plain", None, None, text))
        elif h[3] % 100 < 80:
            out.append((doc_id, len(own), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((doc_id, len(own), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return out
