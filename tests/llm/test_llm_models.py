"""Chat spans, language model, tokenizers and classifiers: round trips, brute force and held-out accuracy."""

import collections
import hashlib
import math
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat, langid, ngram_lm, pretokens, samples, token_counts, toxicity

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
WORD = st.sampled_from(["a", "b", " ", "  ", "\n", "\r\n", "<|endoftext|>", "<|endof", "'s", "'ll", "é", "日本", "123", "!!", "\t", "\xa0", "\x1c", "\x85", "##", "Ab", "😀", "word", " the"])
FUZZ = st.lists(WORD, max_size=30).map("".join)


def as_list(coded):
    return np.frombuffer(coded, "<u4").tolist()


# --- chat -------------------------------------------------------------------------------------------------------------------


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, piece string, n int")


def digests(rows):
    """What must be read back, from the turns themselves."""
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        said = [(role, text) for _, _, role, text in sorted(turns)]
        loss = "".join(text for role, text in said if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        out[conv] = (len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.plain_template(said)))
    return out


CHAT = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "### user: </turn>\n"), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 5, "ass: #<\\", "\\\\n</turn>"),
    (2, None, None, "first"), (None, 0, "assistant", "no id"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"),
    (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"), (4, 0, "user", "long " * 50_000),
]


def test_chat_reads_back(spark):
    got = chat.read_back(chat.format_conversations(conversations(spark, CHAT))).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == digests(CHAT)
    assert chat.read_back(chat.format_conversations(conversations(spark, CHAT).where("false"))).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a\\#<:\n/turn> ", max_size=6), st.text(alphabet="a\\#<:\n/turn> ", max_size=12)), max_size=5))
def test_escapes_are_reversible(turns):
    assert [(role, text) for _, role, text in chat.parse_plain(chat.plain_template(turns))] == turns


def test_spans_of_long_conversations_do_not_depend_on_the_window(spark):
    rows = [(9, k, ("user", "assistant")[k % 2], f"text {k} <#") for k in range(300)]
    spans = lambda window: chat.format_conversations(conversations(spark, rows), window=window).orderBy("n").collect()
    assert spans(16) == spans(512)
    whole = "".join(r["piece"] for r in spans(16))
    assert whole == chat.plain_template([(r[2], r[3]) for r in rows])
    assert all(chat.unescape(whole[r["content_start"] : r["content_end"]]) == rows[r["n"]][3] for r in spans(16))


def test_templates_that_rewrite_history_are_found(spark):
    def forgets(turns):  # earlier answers are cut
        return "".join(f"<{role}>{text if k == len(turns) - 1 else text[:1]};" for k, (role, text) in enumerate(turns))

    def opens(turns):
        return "<s>" + "".join(f"[{role}] {text}\n" for role, text in turns)

    def counts(turns):
        return "".join(f"{k}/{len(turns)} {text}\n" for k, (_, text) in enumerate(turns)) if len(turns) > 40 else "".join(f"{k} {text}\n" for k, (_, text) in enumerate(turns))

    rows = [(1, k, "assistant", f"answer {k}") for k in range(50)]
    with pytest.raises(Exception, match="HistoryRewritten"):
        chat.format_conversations(conversations(spark, rows[:4]), forgets).collect()
    marked = chat.format_conversations(conversations(spark, rows[:4]), forgets, on_rewrite="mark").orderBy("n").collect()
    assert [r["rewrote"] for r in marked] == [False, True, True, True]
    opened = chat.format_conversations(conversations(spark, rows[:4]), opens).orderBy("n").collect()
    assert "".join(r["piece"] for r in opened) == opens([(r[2], r[3]) for r in rows[:4]]) and opened[0]["start"] == 0
    with pytest.raises(Exception, match="looks back|HistoryRewritten"):
        chat.format_conversations(conversations(spark, rows), counts, window=16).collect()


# --- language model -----------------------------------------------------------------------------------------------------------

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def model_scores(train, texts):
    """(n_tokens, n_known, base, score) of each text, from the definition of modified Kneser-Ney smoothing."""
    tokens = lambda t: (t or "").encode().translate(LOWER).split() + [None]
    taught = [tokens(t) for t in train]
    count = collections.Counter(w for t in taught for w in t)
    pairs = collections.Counter(p for t in taught for p in zip([0, *t], t))
    total, size, types = sum(count.values()), len(count), len(pairs)
    after, kinds, before = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (v, w), n in pairs.items():
        after[v] += n
        kinds[v][min(n, 3)] += 1
        before[w] += 1
    of_pairs, of_words = (ngram_lm.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in (pairs, before))
    spare = sum(of_words[min(n, 3)] for n in before.values()) / types if types else 1

    def alone(w):
        return (max(before[w] - of_words[min(before[w], 3)], 0) / types if types else 0) + spare / (size + 1)

    def chance(v, w):
        if not after[v]:
            return alone(w)
        n = pairs[v, w]
        return (max(n - of_pairs[min(n, 3)], 0) + sum(of_pairs[k] * kinds[v][k] for k in (1, 2, 3)) * alone(w)) / after[v]

    out = []
    for text in texts:
        t = tokens(text)
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (size + 1))) for w in t)
        out.append((len(t), sum(count[w] > 0 for w in t), base, sum(math.log10(chance(v, w)) for v, w in zip([0, *t], t))))
    if taught:
        assert math.isclose(sum(chance(0, w) for w in count) + chance(0, b"never seen"), 1)
    return out


def lm_texts():
    draw = random.Random(4)
    names = [f"W{k}" for k in range(40)]
    texts = [" ".join(draw.choices(names, weights=[1 / (k + 1) for k in range(40)], k=draw.randrange(0, 60))) for _ in range(80)]
    return [*texts, None, "", " \n", "unseen words only", "the " * 500, texts[3], texts[3]]


@pytest.mark.parametrize("small", [False, True])
def test_language_model_equals_its_definition(spark, monkeypatch, small):
    if small:  # many ranges, blocks and flushes
        for name, value in (("WORD_RANGE_BYTES", 300), ("PAIR_RANGE_BYTES", 200), ("_FLUSH", 50), ("_ROWS_BYTES", 400)):
            monkeypatch.setattr(ngram_lm, name, value)
    texts = lm_texts()
    docs = spark.createDataFrame([(k, t, "part") for k, t in enumerate(texts)], "id long, text string, part string")
    model = ngram_lm.train(docs.where("id % 3 <> 0"))
    rows = docs.select("id", model.scores("text").alias("s")).orderBy("id").select("s.*").collect()
    want = model_scores([t for k, t in enumerate(texts) if k % 3], texts)
    assert np.allclose(np.array([tuple(r) for r in rows]), np.array(want))


def test_language_model_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "id long, text string")
    model = ngram_lm.train(docs.where("false"))
    assert [tuple(r["s"]) for r in docs.select(model.scores("text").alias("s")).collect()] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert docs.where("false").select(model.scores("text")).collect() == []


def test_unmapped_folders_are_refused():
    assert ngram_lm._shared_folder("file:///a/b") == "/a/b"
    with pytest.raises(ValueError):
        ngram_lm._shared_folder("hdfs://cluster/a")


# --- tokenizers ---------------------------------------------------------------------------------------------------------------

ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MERGES = token_counts.load_merges(public_tokenizers.path("byte_bpe_50k.json"))
COUNTER = token_counts.Counter(MERGES, pretokens.SPACED_PATTERN)
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LONG = ["a" * 5000, "ab" * 3000, " " * 500 + "x", "x" + " " * 500, "#" * 3000, "\n" * 100 + " a \n b", "word " * 2000, "w  " * 1000]


def test_the_pattern_is_the_one_that_is_cut_at_spaces():
    assert public_tokenizers.PATTERN == pretokens.SPACED_PATTERN


@settings(max_examples=300, deadline=None)
@given(FUZZ)
def test_encoding_equals_the_library(text):
    assert as_list(ENCODER.encode(text)) == REFERENCE.encode_ordinary(text)


@pytest.mark.parametrize("text", LONG)
def test_long_pretokens_and_segments(text, monkeypatch):
    monkeypatch.setattr(pretokens, "_SEGMENT", 97)
    assert as_list(ENCODER.encode(text)) == REFERENCE.encode_ordinary(text)
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(FUZZ)
def test_counts_equal_the_library(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_queue_takes_the_lowest_rank_and_leftmost_place():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aab": 300, b"ba": 257, b"aaaa": 258}
    queue = bpe.RankQueue(301)
    assert bpe.merge(b"aaaaab", ranks, queue) == [258, 300 - 300 + 97, 98] and not queue.buckets and not any(queue.words)


def test_many_pretokens_in_one_queue():
    ranks = bpe.Ranks(RANKS)
    queue = bpe.RankQueue(max(RANKS.values()) + 1)
    pieces = [b"", b"aaaa", b" indivisible", b"a", b"", "é漢字".encode(), b"aaaaaaa", b"zzzz zz"]
    assert bpe.merge_all(pieces, ranks, queue) == [bpe.merge(p, RANKS, queue) if p else [] for p in pieces]
    assert bpe.merge_all([], ranks, queue) == [] and not queue.top
    # a merge that opens a lower rank than its own: the rest of the bucket waits for it
    odd = bpe.Ranks({bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 260, b"cab": 256, b"abcab": 257})
    assert bpe.merge_all([b"abcab", b"ab"], odd, bpe.RankQueue(301)) == [[257], [300]]


def test_remembered_pretokens_are_bounded():
    known = bpe.Remembered(limit=1000)
    for k in range(100):
        assert known.missing([f"k{k}"]) == [f"k{k}"]
        known.put(f"k{k}", b"x")
        assert known.young[f"k{k}"] == b"x" and not known.missing([f"k{k}"])
        known.turn()
    assert len(known.young) + len(known.old) <= 16
    assert known.missing(["k98", "k0"]) == ["k0"] and known.young["k98"] == b"x"


def test_whole_tokens_are_proved_and_not_assumed():
    assert all(COUNTER.count(token) == 1 for token in [" the", "ing", "!"] if token in MERGES.whole)
    assert len(MERGES.whole) > 40_000
    pairs = {(1, 2): (5, 10), (2, 3): (0, 11), (10, 3): (6, 12)}
    assert token_counts.merge_ids([1, 2, 3], pairs) == [1, 11]  # its parts merge otherwise, so the string of 12 is no whole token


def test_memory_of_pretokens_is_bounded():
    memo = pretokens.Memo(len, limit=10)
    assert [memo[f"k{n}"] for n in range(100)] == [len(f"k{n}") for n in range(100)]
    assert len(memo) + len(memo._older) <= 20
    assert memo["x" * 1000] == 1000 and "x" * 1000 not in memo


def test_columns_of_byte_pairs(spark):
    pairs = bpe.BytePairs(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = spark.createDataFrame([(1, "Hello wörld <|endoftext|>"), (2, ""), (3, None), (4, LONG[2])], "ids int, text string")
    rows = docs.select("ids", "text", pairs.encode("text").alias("e"), pairs.round_trip("text").alias("r")).collect()
    for r in rows:
        assert r["e"] == as_list(r["r"]["ids"]) == REFERENCE.encode_ordinary(r["text"] or "")
        assert bytes(r["r"]["decoded"]).decode() == (r["text"] or "")
    coded = docs.select(pairs.encode("text").alias("e"))
    assert [bytes(r[0]).decode() for r in coded.select(pairs.decode("e")).collect()] == [r["text"] or "" for r in rows]
    count = token_counts.token_counter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    assert [r[0] for r in docs.select(count("text")).collect()] == [len(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows]
    assert docs.where("false").select(pairs.round_trip("text"), count("text")).collect() == []


# --- classifiers --------------------------------------------------------------------------------------------------------------

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "ne"], "bb": ["sch", "ung", "ein", "keit", "ü"], "cc": ["eau", "oi", "è", "tion", "que"]}


def told(lang, seed, n=60):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def test_language_of_held_out_texts(spark):
    rows = [(k, told(lang, k, 5 + k % 90), lang) for k, lang in enumerate(list(SYLLABLES) * 60)]
    docs = spark.createDataFrame([*rows, (1000, None, "aa"), (1001, told("aa", 1), None)], "doc_id long, text string, lang string")
    model = langid.train_language_model(docs.where("doc_id % 4 <> 2"), per_language=30)
    assert model.languages == sorted(SYLLABLES)
    rest = spark.createDataFrame([(5000, "12 !? 3"), (5001, ""), (5002, None), (5003, told("bb", 3, 3000)), (5004, "日本")], "doc_id long, text string")
    tests = docs.where("doc_id % 4 = 2 and lang is not null").select("doc_id", "text").union(rest)
    found = {r[0]: r[1] for r in tests.select("doc_id", model.predict(tests)).collect()}
    right = [found[k]["lang"] == lang for k, _, lang in rows if k % 4 == 2]
    assert np.mean(right) > 0.95
    assert [found[k]["lang"] for k in (5000, 5001, 5002, 5003)] == ["und", "und", "und", "bb"] and found[5004]["lang"] in SYLLABLES
    assert all(0 <= x["score"] <= 1 for x in found.values())


def test_language_model_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = langid.train_language_model(docs)
    assert docs.select(model.predict(docs).alias("p")).first()["p"].asDict() == {"lang": "und", "score": 0.0}
    assert docs.where("false").select(model.predict(docs)).collect() == []


@given(st.integers(0, 1000))
@settings(max_examples=50, deadline=None)
def test_windows_hold_every_byte(n):
    data = (np.arange(n) % 251 + 1).astype(np.uint8)
    rows = langid.windows_of(data)
    assert rows.shape[1] == langid.WINDOW and rows.size < n + 2 * langid.WINDOW
    whole = n // langid.WINDOW
    assert (rows[:whole].ravel() == data[: whole * langid.WINDOW]).all() and bytes(data[-langid.WINDOW :]) in bytes(rows[-1])


BAD = ["worthless", "pathetic", "disgusting", "scum", "moron"]


def remark(k, toxic):
    text = told("aa", k, 40).split()
    draw = random.Random(k)
    for _ in range(4 if toxic else 0):
        text.insert(draw.randrange(len(text)), draw.choice(BAD))
    return " ".join(text)


def test_toxicity_of_held_out_texts(spark):
    rows = [(k, remark(k, k % 5 == 1), int(k % 5 == 1)) for k in range(600)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5] + [(None, 1), (1, None), (9000, 0), (77777, 1)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    score = {r[0]: r[1] for r in docs.select("doc_id", model.score(docs)).collect()}
    held = [(score[k] >= 0.5, y == 1) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    caught, wrong = np.mean([p for p, y in held if y]), np.mean([p for p, y in held if not y])
    assert caught > 0.9 and wrong < 0.05
    assert all(0 <= s <= 1 for s in score.values()) and score[9000] < 0.5 and score[9001] == score[9000]


def test_toxicity_without_a_class(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert docs.select(model.score(docs)).first()[0] == 0.0
    few = toxicity.fit([b"you moron scum"], [b"good day to you"], 0.5)
    assert few.score_batch(pa.array([b"moron scum", None], pa.binary()))[0].as_py() > 0


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.createDataFrame([(k % 50, "a" if k % 50 < 40 else "b") for k in range(200)] + [(None, "a"), (3, None)], "id long, label string")
    chosen = sorted(map(tuple, samples.sample_by_class(rows, 7).collect()))
    assert collections.Counter(label for _, label in chosen) == {"a": 7, "b": 7}
    assert chosen == sorted(map(tuple, samples.sample_by_class(rows.orderBy("label"), 7).collect()))
    assert brute.words(None) == []
