"""Fingerprints, pieces, packing, quality and rules against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD
from tokenizers import Tokenizer

from pulsegrid.llm import edit_prints, packing, pieces, quality, rules

MODEL, WORD_BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_edited_prints(spark, docs_of, prose):
    texts = ODD + [prose(n, n) for n in (1, 3, 50, 400)]
    docs = docs_of(texts, fingerprint="clash", __run="clash")
    got = {r["doc_id"]: r for r in edit_prints.edited_prints(docs).collect()}
    own, order = edit_prints.EditPrinter(), list(reversed(range(len(texts))))
    for at, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["fingerprint"] == edit_prints.as_hex(own.print_of(text))
        assert got[i]["edited_fingerprint"] == edit_prints.as_hex(own.print_of(edited))
        assert got[i]["near_next"] == own.likeness(own.print_of(text), own.print_of(following))


def test_edited_prints_of_few_rows(spark, docs_of):
    assert edit_prints.edited_prints(docs_of([])).collect() == []
    (row,) = edit_prints.edited_prints(docs_of(["abcd"])).collect()
    assert row["near_next"] == 1 and row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    twice = spark.createDataFrame([(None, "a"), (None, "b"), (3, "c"), (3, "c")], "doc_id long, text string")
    assert edit_prints.edited_prints(twice).count() == 4


def test_likeness_falls_with_edits(prose):
    own, text, rng = edit_prints.EditPrinter(), prose(400, 1), random.Random(2)
    near = []
    for edits in (0, 2, 20, 400):
        chars = list(text)
        for _ in range(edits):
            chars.insert(rng.randrange(len(chars)), "q")
        near.append(own.likeness(own.print_of(text), own.print_of("".join(chars))))
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[1] > 0.8
    assert own.likeness(own.print_of(text), own.print_of(prose(400, 9))) < 0.3


def test_near_prints_groups(spark, docs_of, prose):
    base = prose(300, 3)
    texts = [base, base, base[:700] + "!" + base[700:], prose(300, 4), None, ""]
    prints = edit_prints.edit_prints(docs_of(texts))
    got = {r["doc_id"]: r["root"] for r in edit_prints.near_prints(prints).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 4: 4, 5: 4}


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(MODEL)


def best_by_dynamic_programming(codec, model, word):
    score = {p: (model.get_score(i), i) for p, i in model.items}
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - model.longest), end):
            options = []
            if word[start:end] in score:
                s, i = score[word[start:end]]
                options.append((best[start][0] + s, [*best[start][1], i]))
            elif end - start == 1:
                raw = word[start:end].encode()
                options.append((best[start][0] + codec.floor * len(raw), [*best[start][1], *(codec.bytes[b] for b in raw)]))
            for o in options:
                if best[end] is None or o[0] > best[end][0]:
                    best[end] = o
    return best[-1]


def test_viterbi_finds_the_best_score(codec, prose):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    class Model:
        items = [(sp.id_to_piece(i), i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        longest = max(len(p) for p, _ in items)
        get_score = staticmethod(sp.get_score)

    scores = {i: sp.get_score(i) for _, i in Model.items}
    for text in [*filter(None, ODD[:9]), prose(40, 5), "a  b", "\u2581x", "tab\there\nline"]:
        marked = "\u2581" + text.replace(" ", "\u2581")
        best, _ = best_by_dynamic_programming(codec, Model, marked)
        own = sum(scores.get(i, codec.floor) for i in codec.encode(text))
        assert own == pytest.approx(best), text


def test_pieces_round_trip(spark, docs_of, codec, prose):
    texts = [*ODD, prose(200, 6), "  lead and trail  ", "a\u00a0b\r\nc"]
    docs = docs_of(texts, ids="clash", decoded="clash")
    back = pieces.decode_pieces(pieces.encode_pieces(docs, MODEL), MODEL).orderBy("doc_id").collect()
    assert [r["decoded"] for r in back] == [t or "" for t in texts]
    assert [r["ids"] for r in back] == [codec.encode(t or "") for t in texts]
    digest = pieces.piece_digest(docs, MODEL).orderBy("doc_id").collect()
    assert all(r["round_trip"] for r in digest) and [r["n_ids"] for r in digest] == [len(r["ids"]) for r in back]
    assert pieces.piece_digest(docs_of([]), MODEL).collect() == []


def test_packing_covers_every_token(spark, docs_of, prose):
    texts = ODD + [prose(n, n) for n in (5, 30, 31, 32, 700, 1500, 4000)] + ["it's x\u00b2 \u0130 \u03a3\u03b1\u03a3 <|endoftext|> a\x0bb"]
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack_documents(docs_of(texts, sequence_id="clash", length="clash"), WORD_BPE, capacity=256).collect()
    total = 0
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 256)) and sum(r["length"] for r in own) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= -(-total // 256) + 1
    assert packing.pack_documents(docs_of([]), WORD_BPE).collect() == []


def test_known_chunks_are_looked_up_once(prose):
    class Counting(packing.Cache):
        looked = 0

        def get(self, *a):
            self.looked += 1
            return super().get(*a)

        def __getitem__(self, k):
            self.looked += 1
            return super().__getitem__(k)

        def __contains__(self, k):
            self.looked += 1
            return super().__contains__(k)

    own = packing.ChunkTokenizer(WORD_BPE)
    texts = [*(prose(80, i) for i in range(6)), *(t or "" for t in ODD), "Don't <|x|> 12ab, \u00e9t\u00e9 \u4e2d\u6587 a_b"]
    own.chunks = Counting(10)  # so few that chunks go and come back
    want = [np.array(own.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [own.packed([t])[0] for t in texts] == want == own.packed(texts)
    own.chunks = Counting(packing.CACHED_CHUNKS)
    assert own.packed(texts) == want
    own.chunks.looked = 0
    assert own.packed(texts) == want
    assert own.chunks.looked <= sum(len(t.replace("\n", " ").split(" ")) for t in texts)


def test_plan_uses_every_piece():
    rng = random.Random(8)
    for top in (1, 40, 2048):
        counts = Counter(rng.randint(1, top) for _ in range(5000)) + Counter({2048: 7})
        plan = packing.plan(counts, 2048)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 2048 and times > 0
            for n in lengths:
                used[n] += times
        assert used == counts
        least = -(-sum(n * c for n, c in counts.items()) // 2048)
        assert sum(t for _, t in plan) <= least * 1.03 + 1
    assert packing.plan({}, 2048) == []


def test_quality(spark, docs_of, prose):
    texts = [prose(60, i) if i % 4 else (prose(20, i).upper().replace(" ", "!! ") if i % 8 else "no no no no " * 20) for i in range(600)] + ODD
    docs = docs_of(texts, score="clash")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(None, 1), (700, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, quality.learnable(labels))
    got = {r["doc_id"]: r for r in quality.score_quality(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i]["score"] >= 0.3) == (i % 4 != 0) for i in held]) > 0.97
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[600]["score"] == got[601]["score"]  # null and empty
    assert got[1]["text"] == texts[1] and got[1]["lang"] == "en"


def test_quality_without_labels(spark, docs_of):
    docs = docs_of(["a", None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score_quality(docs, quality.fit_quality(docs, none)).collect()] == [1.0, 1.0]
    assert quality.score_quality(docs_of([]), quality.fit_quality(docs_of([]), none)).collect() == []


def test_repeated_neighbours_stay_within_a_text():
    stem, shape, bounds = quality.coded(["a a", "a", "", "a b"])
    assert bounds.tolist() == [0, 2, 3, 3, 5] and (shape >= quality.SHAPES).tolist() == [False, True, False, False, False]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_counts(spark, docs_of, prose):
    line = prose(12, 1)
    texts = [*ODD, f"{line}\n{line}\n \n\n{line}x", "a b c d e a b c d e f", "z " * 40, "#*$%&|<> \x0b\x0c\r\u00a0", prose(300, 2) + "\n" + prose(300, 2)]
    got = rules.judge_quality(docs_of(texts, n_words="clash", distance="clash")).orderBy("doc_id").collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[c] for c in columns) for r in got] == [plain_counts(t or "") for t in texts]
    assert [r["base_failed"] for r in got] == [n < 10 or 100 * rep > 20 * n for n, *_, rep in map(plain_counts, (t or "" for t in texts))]


def test_outliers_go_and_ordinary_texts_stay(spark, docs_of, prose):
    texts = [prose(80, i) for i in range(300)] + [prose(80, i).replace(" ", "### ") for i in range(20)] + [prose(80, 7).upper()] + [None]
    docs = docs_of(texts, kept="clash", g="clash")
    kept = {r["doc_id"] for r in rules.keep_quality(docs).collect()}
    assert kept == set(range(300))
    assert rules.keep_quality(docs).columns == docs.columns
    copies = docs_of([prose(80, 1)] * 290 + [prose(80, i) for i in range(2, 12)])  # copies must not make others outlying
    assert rules.keep_quality(copies).count() == 300
    assert rules.keep_quality(docs_of([])).count() == 0


def test_small_groups_and_null_names(spark, prose):
    rows = [(i, prose(40, i), None if i % 2 else "en", None if i % 3 else f"s{i}") for i in range(30)] + [(5, prose(40, 99), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert rules.keep_quality(docs).count() == 31  # too few documents for a verdict


def test_determinant_and_inverse(spark):
    from pyspark.sql import functions as F

    m = np.diag([2.0, 3, 4, 5, 6]) + 0.5
    got = spark.range(1).select(rules._inverted(F.array(*(F.lit(float(x)) for x in m.ravel()))).alias("v")).first()["v"]
    assert np.allclose(np.array(got[:25]).reshape(5, 5), np.linalg.inv(m)) and got[25] == pytest.approx(np.linalg.det(m))
