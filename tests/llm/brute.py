"""Plain-Python versions of the operators, written from their definitions."""

from __future__ import annotations

import collections
import functools
import hashlib
import re

import xxhash

UPPER = dict(zip(range(65, 91), range(97, 123)))
SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate(UPPER)


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    windows = collections.Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {i + k for i in range(len(found) - 4) for k in range(5) if windows[tuple(found[i : i + 5])] > 1}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def contamination(text, items, window=10):
    """n_words, n_hit, items with occurring windows."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    doc, hit, names = cut(text), set(), set()
    for name, item in items:
        said = cut(item)
        size = min(window, len(said))
        for j in range(len(said) - size + 1 if size else 0):
            for p in range(len(doc) - size + 1):
                if doc[p : p + size] == said[j : j + size]:
                    hit.update(range(p, p + size))
                    names.add(str(name))
    return len(doc), len(hit), sorted(names)


def fingerprint(text, width=3):
    found = words(lower(text))
    shingles = [" ".join(found[k : k + width]) for k in range(len(found) - width + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(ids, linked):
    """Least id that each id reaches."""
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def line_key(line):
    return lower(line.strip(SPACE))


def dedup_lines(docs, min_chars=20, min_docs=3):
    """{id: kept text} for distinct ids."""
    holders = collections.defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(i)
    drop = {k: max(ids) for k, ids in holders.items() if len(k) >= min_chars and len(ids) >= min_docs}
    return {i: "\n".join(line for line in (text or "").split("\n") if drop.get(line_key(line), i) == i) for i, text in docs}


def repeated_spans(texts, length):
    """For each text the spans of its bytes that are covered by a string of ``length`` bytes starting at two places."""
    raws = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    starts = collections.Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        spans = []
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append(spans)
    return out


def without_repeats(text, spans):
    """n_bytes, n_removed, n_spans, kept_sha256."""
    raw = (text or "").encode()
    edges = [0, *[x for span in spans for x in span], len(raw)]
    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


def two_tokenizers():
    """Each side as (text to ids, bytes of an id), straight from the libraries."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    piece = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("\u2581", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids, lambda k: bytes(letters[c] for c in a.id_to_token(k))), (b.encode, piece)


def alignments(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text."""
    sides, found, pairs = two_tokenizers(), [], collections.Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        ids = [side[0](text) if text else [] for side in sides]
        ends = []
        for side, numbers in zip(sides, ids):
            parts = [side[1](k) for k in numbers]
            ends.append([sum(map(len, parts[: i + 1])) for i in range(len(parts))] if b"".join(parts) == raw else None)
        if None in ends:
            found.append(None)
            continue
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            left, right = [], []
            while i < len(ends[0]) and ends[0][i] <= cut:
                left.append(ids[0][i])
                i += 1
            while j < len(ends[1]) and ends[1][j] <= cut:
                right.append(ids[1][j])
                j += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            links.append((left[-1], right[-1]))
        pairs.update(links)
        found.append((*map(len, ids), ";".join(groups), links))
    best = collections.defaultdict(int)
    for (_, b), count in pairs.items():
        best[b] = max(best[b], count)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if x is None
        else (x[0], x[1], len(x[3]), len(x[3]), sum(pairs[p] == best[p[1]] for p in x[3]), sum(pairs[p] for p in x[3]), hashlib.sha256(x[2].encode()).hexdigest() if x[2] else "")
        for x in found
    ]


@functools.cache
def library_of_ranks():
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_pairs(text):
    """n_tokens, ids_sha256, decoded_sha256."""
    ids = library_of_ranks().encode_ordinary(text or "")
    return len(ids), hashlib.sha256(b"".join(k.to_bytes(4, "little") for k in ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@functools.cache
def library_of_merges():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_count(text):
    """n_bytes, n_tokens, over_limit."""
    tokens = len(library_of_merges().encode(text or "", add_special_tokens=False).ids)
    return len((text or "").encode()), tokens, tokens > 512
