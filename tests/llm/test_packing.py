import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from rivulet.llm.packing import WordIds, cuts, default_tokenizer, pack

SCHEMA = "doc_id long, text string, offset string"


def check(out, rows, capacity=2048):
    t = Tokenizer.from_file(default_tokenizer())
    want = sorted((d, tuple([*t.encode(x or "", add_special_tokens=False).ids, 1])) for d, x in rows)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in out:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id, r.doc_tokens].append((r.start, tuple(ids.tolist())))
    padding = 0
    for places in by_seq.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    whole = defaultdict(int)
    for d, ids in want:
        whole[d, ids] += 1
    for (d, n), times in list(whole.items()):
        pieces = sorted(by_doc[d, len(n)])
        assert len(pieces) == times * len(set(p[0] for p in pieces))
        joined = sum((p[1] for p in pieces[::times]), ())
        assert joined == n
    assert sum(len(p) for p in by_seq.values()) == len(out)
    return padding / sum(r.length for r in out)


def test_cuts():
    assert cuts(5000) == [2048, 2048, 512, 256, 128, 8] and cuts(1) == [1] and sum(cuts(2047)) == 2047


def test_real_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    out = pack(df, with_ids=True).collect()
    assert check(out, [(r.doc_id, r.text) for r in df.collect()]) < 0.02


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "é b\x1cC\x85d <|endoftext|> ｆｕｌｌ é İ"), (5, "word, it's 123! " * 4000), (6, "x" * 30000), (7, "same"), (7, "same"), (8, " \n\t "), (9, "<|endoftext|>"), (10, "long " * 3000 + "<|startoftext|>end <|ENDOFTEXT|>")]
    df = spark.createDataFrame([(*r, "o") for r in rows], SCHEMA).repartition(3)
    check(pack(df, with_ids=True).collect(), rows)
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []
    assert pack(df).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_ids_by_words_are_those_of_the_whole_text():
    t = Tokenizer.from_file(default_tokenizer())
    texts = ["İstanbul, ΣΑΣ. ǅ don't can't, it's 've... éa, ﬁn A.B.C! ½ x²y ª º ñandú; Ünder: ẞ ß!", "a b\tc\x0bd  e ,.; !? 1,2. 3! ɐ ʰ ᵃ 中文, 日本。 ꙮ 𝐀 👩‍👩‍👧", "<|startoftext|> <|endoftext|>, K Å ſ"]
    assert [np.frombuffer(x, "<u4").tolist() for x in WordIds(default_tokenizer())(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_fuzzed_texts_with_added_tokens():
    t = Tokenizer.from_file(default_tokenizer())
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "endoftext", "word", "İ", " ", "\n", ", ", "it's", "12", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in WordIds(default_tokenizer())(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_common_words_stay_known_and_memory_has_a_bound(monkeypatch):
    monkeypatch.setattr("rivulet.llm.packing.CACHED_WORDS", 300)
    asked = []
    learn = WordIds._learn
    monkeypatch.setattr(WordIds, "_learn", lambda self, parts: (asked.extend(parts), learn(self, parts))[1])
    letters = [chr(97 + k) for k in range(26)]
    ids, t, kept = WordIds(default_tokenizer()), Tokenizer.from_file(default_tokenizer()), 0
    for k in range(30):
        text = "the common, Words stay " + " ".join(f"q{letters[k % 26]}{letters[k // 26]}{a}{b}," for a in letters[:10] for b in letters[:10])
        assert np.frombuffer(ids([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        kept = max(kept, sum(len(d) for d in vars(ids).values() if isinstance(d, dict)))
    assert asked.count("the") == asked.count("common") == asked.count("words") == 1
    assert kept <= 2 * (300 + 2 * 104)
