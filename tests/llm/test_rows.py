"""Packing, fingerprints, sharding and language ID on small tables, against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from drover.llm import fingerprints, language, packing, sharding
from drover.llm.queries import QUERIES, TOKENIZER, held_out
from drover.llm.text import Words, shingles, utf8
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "\n\n", "a", "A b", "x\ty\u00a0z  w", "<|endoftext|> it's", "É e\u0301 \u0301x", "the " * 5000, "12 3-4", "ΑΣ ΟΔΟΣ"]
PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def docs(spark):
    from drover.llm.shipping import ship

    ship(spark)
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def odd(spark):
    rows = [(k if k % 5 else None, t, "x", 7) for k, t in enumerate([*TEXTS, *TEXTS])]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, length int")


def test_word_hashes():
    texts = ["The cat.\tthe", "", "cat", None, "x  the", " "]
    words = Words(*utf8(pa.array(texts, pa.string())))
    assert words.counts.tolist() == [3, 0, 1, 0, 2, 0]
    named = defaultdict(set)
    for h, w in zip(words.hash.tolist(), "the cat. the cat x the".split()):
        named[w].add(h)
    assert all(len(v) == 1 for v in named.values()) and len(set.union(*named.values())) == 4


def test_shingles_like_sets():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 1, 3, 4, 5, 6, 30, 200)] * 2
    owner, value = shingles(Words(*utf8(pa.array(texts))), len(texts), 5)
    for k, text in enumerate(texts):
        w = text.split()
        expected = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert (owner == k).sum() == len(expected)
    half = len(texts) // 2
    assert value[owner < half].tolist() == value[owner >= half].tolist()


def test_packing_like_plain_encoding(spark, docs):
    frame = docs.select("doc_id", "text").union(odd(spark).select("doc_id", "text"))
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for row in frame.collect():
        ids = np.array([*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        start = 0
        for length in packing.lengths(len(ids), 2048):
            piece = ids[start : start + length]
            expected[(row["doc_id"], start, length, tuple(piece.tolist()), zlib.crc32(piece.tobytes()), len(ids))] += 1
            start += length
        assert start == len(ids)
    rows = packing.pack(frame, PATH).collect()
    mine = Counter((r["doc_id"], r["start"], r["length"], tuple(r["ids"]), r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert mine == expected
    assert len({r["sequence_id"] for r in rows}) == len(rows) and {r["offset"] for r in rows} == {0}
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 for r in rows)


ODD = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>x", "İ", "HEPSİ.", "İ,", "i\u0307.", "Σ", "ΟΔΟΣ.", "ς,", "ſ.",
       "\t", "\u0301", "e\u0301.", "É,", "ÀÉ", "ǅ.", "ª,", "ŉ.", "it's", "I'LL", "''s", "12.", "a.b", "..", ".", ",", "“x”", "\u00a0",
       "\u2028", "\x0b", "\x85", "\u200b", "ꟑ.", "\U00010d50.", "한글.", "ﬁ", "Ⅷ.", "²,", "x" * 300, "Z" * 70 + "."]


def test_encoder_like_the_tokenizer():
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    rng = np.random.default_rng(5)
    blanks = ["", " ", "\n", "  ", " \n"]
    letters = [chr(c) for c in [*range(32, 0x260), *range(0x300, 0x370), *range(0x370, 0x400), 0x1E9E, 0x212A, 0x2160, 0xA7D0]]
    texts = ["x <|ENDOFTEXT|> y", *ODD]
    for _ in range(3000):
        words = [rng.choice(ODD) if rng.random() < 0.6 else "".join(rng.choice(letters, rng.integers(1, 5))) for _ in range(6)]
        texts.append("".join(w + rng.choice(blanks) for w in words))
    ids, bounds = encoder.encode(texts)
    for text, low, high in zip(texts, bounds, bounds[1:]):
        assert ids[low:high].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


class Counted:
    """A function that keeps what it was called with."""

    def __init__(self, function):
        self.function, self.calls = function, []

    def __call__(self, word, **more):
        self.calls.append(word)
        return self.function(word, **more)


def test_words_met_lately_stay_known(monkeypatch):
    """A full store loses the words that no lot has had since the last time, not those that come again and again."""
    monkeypatch.setattr(packing, "KEPT_BYTES", 40_000)
    encoder = packing.Encoder(PATH)
    encoder.merges = Counted(encoder.merges)
    rare = ["".join(chr(97 + k // 26**i % 26) for i in range(4)) for k in range(2000)]
    for k in range(0, 2000, 40):
        encoder.encode([" ".join(["often", "again", *rare[k : k + 40]])])
    calls = Counter(encoder.merges.calls)
    assert calls["often"] == calls["again"] == 1 and set(rare) <= set(calls)
    assert len(encoder.store) + len(encoder.older) < 300


def test_plain_words_are_split_like_the_tokenizer_does():
    """Only words with other characters, with what may be a special token, or very long ones take the whole tokenizer."""
    plain = ["it's", "I'LL", "''s", "'re''ve", "x'", "rent***", "by.!!", "a.b,", "(363)", "12.5", "a1b2", "½x²", "ªº", "ß§,", "ÀÉ'S",
             "Straße.", "niño,***", "été&&&", "×÷", "\u00adx", "<a|b>", "|<", *packing.PLAIN]
    other = ["İx", "e\u0301.", "a\tb", "x\u00a0y", "\u0181.", "\u212a,", "<|endoftext|>", "a<|b", "\x1cx", "\x85", "ΟΔΟΣ.", "Ab1," * 300]
    rng = np.random.default_rng(7)
    plain += ["".join(rng.choice(list("'sdm.lvert1é²À-"), rng.integers(2, 9))) for _ in range(3000)]
    tokenizer, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    encoder.tokenizer = whole = Counted(tokenizer.encode)
    whole.encode = whole
    for word in plain + other:
        ids = np.frombuffer(encoder.of(word), dtype="<u4")
        assert ids.tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word
    beyond = [c for c in packing.PLAIN if max(c.lower()) > "\u024f"]
    assert set(whole.calls) == {*other, *beyond}


def test_texts_are_cut_at_blanks():
    for text in ["", "a", "a b c d e", "aaaaaaaa b", "aaaaaaaaaa", "a\nbbbbbbb c ", "     ", "ab cd\nef gh"]:
        parts = list(packing.cut(text, 4))
        assert "".join(parts) == text and all(p[-1] in " \n" for p in parts[:-1])


def test_long_texts_and_many_lots(spark, docs, monkeypatch):
    """Lots of a few characters and a store of a few words give the same pieces."""
    frame = docs.select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in packing.pack(frame, PATH).drop("sequence_id").collect()]
    text = " ".join(r["text"] or "" for r in docs.collect()) * 4
    assert len(text) > packing.LOT
    long = spark.createDataFrame([(1, text), (2, "x" * (packing.LOT + 5)), (3, None)], "doc_id long, text string")
    whole = packing.pack(long, PATH).groupBy("doc_id").agg({"length": "sum"}).collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert {r[0]: r[1] - 1 for r in whole} == {
        k: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for k, t in [tuple(r) for r in long.collect()]}
    encoder = packing.Encoder(PATH)
    monkeypatch.setattr(packing, "KEPT_BYTES", 1000)
    for key, some in [tuple(r) for r in frame.collect()]:
        parts = list(packing.cut(some or "", 50))
        ids = np.concatenate([*(encoder.encode([p])[0] for p in parts), [1]])
        assert len(ids) == next(r[5] for r in rows if r[0] == key)


def test_packing_buckets_and_empty(spark, docs, tmp_path):
    packed = packing.pack(docs, PATH, longest=64)
    sizes = {r["length"]: r["tokens"] for r in packing.bucket_sizes(packed).collect()}
    assert set(sizes) <= {1 << k for k in range(7)}
    packing.write_buckets(packed, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == packed.count()
    assert packing.pack(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, longest=48)


def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        part = len(text) // 4
        out.append((key, len(text), hashlib.sha256((text[: len(text) - part] + after[:part]).encode()).hexdigest()))
    return out


def test_fingerprints(spark, docs):
    band = fingerprints.lexicon(docs)
    rows = fingerprints.compare_with_edits(docs.repartition(5), band).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == sorted(edited(list(texts.items())))
    same = defaultdict(set)
    for r in rows:
        same[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    assert np.mean([r["near_edited"] for r in rows]) > 0.4 > 0.15 > np.mean([r["near_next"] for r in rows])


def test_fingerprint_lexicon_is_exact(spark, docs):
    texts = [r["text"] or "" for r in docs.collect()]
    words = Words(*utf8(pa.array(texts)))
    held = Counter(h for t in range(len(texts)) for h in set(words.hash[words.text == t].tolist()))
    least, most = 2, 20
    expected = sorted(h for h, n in held.items() if least <= n <= most)
    assert fingerprints.lexicon(docs, least / len(texts), most / len(texts)).tolist() == expected


def plain_mix(value):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        value = (value ^ value >> shift) * factor % 2**64
    return value


def plain_print(terms, band):
    """Fingerprint of a set of word hashes, subset by subset."""
    *salts, last = fingerprints._SALTS.tolist()
    sixteen, levels = fingerprints.SUBSETS, fingerprints.LEVELS

    def entry(drawn):
        total = plain_mix(sum(map(plain_mix, drawn)) % 2**64)
        return total % 255 + 1 if drawn else 0

    out = []
    for level in range(levels):
        for salt in salts:
            drawn = [plain_mix(t ^ salt) for t in terms if t in band]
            out.append(entry([d for d in drawn if d % 2**level == 0]))
    for level in range(fingerprints.SPARSE, levels):
        for subset in range(sixteen):
            drawn = [d for d in (plain_mix(t ^ last) for t in terms) if d % sixteen == subset]
            out.append(entry([d for d in drawn if (d >> 4) % 2 ** (level - 4) == 0]))
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    pairs, sixteen = [], fingerprints.SUBSETS
    for begin in (4 * sixteen, fingerprints.LEVELS * sixteen):
        found = []
        for level in range(fingerprints.LEVELS - 4):
            at = begin + level * sixteen
            held = [(x, y) for x, y in zip(a[at : at + sixteen], b[at : at + sixteen]) if x or y]
            if level == 0 or 2 * len(held) >= sixteen:
                found = held
        pairs += found
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def test_fingerprints_like_plain_ones(spark, docs):
    band = fingerprints.lexicon(docs)
    held, texts = set(band.tolist()), [r["text"] or "" for r in docs.collect()][:40] + [t or "" for t in TEXTS]
    words = Words(*utf8(pa.array(texts)))
    table = fingerprints.imatch(pa.array(texts), band)
    assert table.shape == (len(texts), fingerprints.WIDTH)
    plain = [plain_print(set(words.hash[words.text == t].tolist()), held) for t in range(len(texts))]
    assert table.tolist() == plain
    near = fingerprints.likeness(table, np.roll(table, -1, axis=0))
    expected = [plain_likeness(a, b) for a, b in zip(plain, [*plain[1:], plain[0]])]
    assert near.tolist() == pytest.approx(expected)
    columns = docs.limit(30).select("doc_id", "text")
    shown = {r["doc_id"]: (r["text"], r["fingerprint"]) for r in fingerprints.fingerprint(columns, band).collect()}
    for text, hexed in shown.values():
        assert hexed == bytes(fingerprints.imatch(pa.array([text], pa.string()), band)[0]).hex()


def test_likeness_is_steady_as_band_words_come_and_go():
    rng = np.random.default_rng(3)
    band = [f"b{k}" for k in range(20)]
    hashes = np.sort(Words(*utf8(pa.array([" ".join(band)]))).hash)
    for count in range(0, 13):  # an edit that takes one of the band words away
        texts = []
        for _ in range(40):
            rare = [f"r{x}" for x in rng.integers(0, 10**9, 60)]
            inside = list(rng.choice(band, count, replace=False))
            texts += [" ".join(inside + rare), " ".join(inside[1:] + rare), " ".join(inside + [f"q{x}" for x in rng.integers(0, 10**9, 60)])]
        table = fingerprints.imatch(pa.array(texts), hashes)
        assert fingerprints.likeness(table[0::3], table[1::3]).mean() > 0.7
        # Unlike texts that share all their words in the band agree on those alone.
        assert fingerprints.likeness(table[0::3], table[2::3]).mean() < 0.7


def test_fingerprints_of_odd_rows(spark):
    frame = odd(spark).where("doc_id IS NOT NULL")
    band = fingerprints.lexicon(frame)
    rows = fingerprints.compare_with_edits(frame, band).collect()
    assert len(rows) == frame.count()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in frame.collect())
    assert fingerprints.compare_with_edits(frame.limit(0), band).count() == 0
    one = fingerprints.compare_with_edits(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), band).first()
    assert one["near_next"] == 1.0
    nulls = fingerprints.compare_with_edits(spark.createDataFrame([(None, "a"), (None, None), (None, "a")], "doc_id long, text string"), band)
    assert nulls.count() == 3
    printed = fingerprints.fingerprint(odd(spark), band).collect()
    assert len(printed) == odd(spark).count() and printed[0]["length"] == 7


def test_sharding(spark, docs):
    for frame in (docs.select("doc_id", "text"), odd(spark), docs.limit(3), docs.limit(0)):
        rows = sharding.shuffle_rows(frame, 8, seed=3, bucket_bytes=40_000).collect()
        plain = frame.collect()
        assert Counter(tuple(r)[: len(frame.columns)] for r in rows) == Counter(map(tuple, plain))
        slots = defaultdict(list)
        for r in rows:
            slots[r["shard"]].append(r["slot"])
        sizes = [len(slots[s]) for s in range(8)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_of_columns_without_nulls_and_wide_ones(spark):
    df = spark.range(500).select("id", F.lit("a").alias("text"), F.repeat(F.lit("x"), 2000).alias("wide"),
                                 F.array("id").alias("list"), F.struct("id").alias("nested"))
    assert not df.schema["id"].nullable
    rows = sharding.shuffle_rows(df, 3, bucket_bytes=100_000)
    assert sorted(r["id"] for r in rows.collect()) == list(range(500))
    assert {len(r["wide"]) for r in rows.collect()} == {2000}
    # A million bytes need ten buckets, whatever column they are in.
    assert df.agg(F.sum(sharding._bytes(df.schema))).first()[0] > 1_000_000


def test_sharding_is_repeatable_and_seeded(spark, docs):
    def order(seed):
        rows = sharding.shuffle_rows(docs, 2, seed, 30_000).collect()
        return [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]

    assert order(1) == order(1) != order(2)
    assert abs(np.corrcoef(order(1), range(200))[0, 1]) < 0.3


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, rng).tolist() == []


def test_language_on_held_out_rows(spark):
    rows = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows) and np.mean([r["rejected"] for r in rows]) < 0.01


def test_language_of_odd_rows(spark, docs):
    model = language.fit(docs.where(~held_out(5)), sample_per_language=30, centroids=2)
    frame = odd(spark)
    rows = language.identify(frame, model).collect()
    assert len(rows) == frame.count() and rows[0].asDict().keys() == {*frame.columns, "lang_pred", "score", "rejected"}
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model.languages
    assert language.identify(frame.limit(0), model).count() == 0
    none = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(spark.createDataFrame([("x",)], "text string"), model).count() == 1
    strange = spark.createDataFrame([("你好世界" * 40,)], "text string")
    assert language.identify(strange, model).first()["rejected"]
