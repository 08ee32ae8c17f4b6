import random

import public_tokenizers as P
import pyarrow as pa
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from quarrysight.llm import sentencepiece_viterbi as V

from .helpers import awkward, empty

PATH = P.path("piece_bpe_32k.model")
MODEL = V.PieceModel(PATH)
TEXTS = ["", None, " ", "  two  spaces ", "then the end", "日本語 テスト", "😀 a😀\n\n x", "<s> </s> <0x41>", "▁ mark▁", "tab\tand nbsp",
         "a" * 3000, "the cat " * 20000, "\x00\x01"]


def unigram():
    """The library's own unigram model over the same pieces and scores."""
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_best_score_is_the_librarys():
    sp = unigram()
    rng = random.Random(5)
    some = ["the", "he", "in", "th", "tion", " ", "xq", "é", "ing", "q", " a"]
    for _ in range(300):
        t = "".join(rng.choice(some) for _ in range(rng.randint(1, 12))).strip() or "x"
        best = max(sp.nbest_encode_as_ids(t, 3), key=lambda ids: sum(map(sp.get_score, ids)))
        (got,) = MODEL.encode(pa.array([t]))
        if MODEL.byte_of.keys().isdisjoint(got.tolist()):
            assert sum(map(sp.get_score, got.tolist())) == sum(map(sp.get_score, best)), t
        assert sp.decode(got.tolist()) == t


def test_against_a_plain_viterbi():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    score = {MODEL.pieces[i]: sp.get_score(i) for i in range(259, 32000)}

    def slow(text):
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        for end in range(1, n + 1):
            for start in range(max(0, end - 48), end):
                if text[start:end] in score:
                    best[end] = max(best[end], best[start] + score[text[start:end]])
            if text[end - 1] not in score:
                best[end] = max(best[end], best[end - 1] + MODEL.floor)
        return best[n]

    ids = {p: i for i, p in enumerate(MODEL.pieces) if i >= 259}
    for t in ["▁then▁the", "▁日本語", "▁x😀y", "▁▁▁a", "▁internationalization", "▁ð"]:
        got = MODEL.viterbi(t).tolist()
        plain = [i for i in got if i not in MODEL.byte_of]
        unknown = sum(c not in ids for c in t)
        value = sum(score[MODEL.pieces[i]] for i in plain) + unknown * MODEL.floor
        assert abs(value - slow(t)) < 1e-6, t


def test_parts_do_not_change_the_path():
    for t in ["then the end", "a  b", "the cat " * 50]:
        (whole,) = MODEL.encode(pa.array([t]))
        assert whole.tolist() == MODEL.viterbi((" " + t).replace(" ", V.SPACE)).tolist()


def test_documents_round_trip(spark):
    docs = awkward(spark, TEXTS + [(3, "tie"), (3, "tie"), (None, "null id")])
    out = V.encode_documents(docs, PATH)
    assert out.columns[:7] == docs.columns
    rows = out.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    back = V.decode_documents(out.drop("text"), PATH).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    assert V.encode_documents(empty(spark), PATH).count() == 0


def test_clashing_columns_and_bad_ids(spark):
    df = spark.createDataFrame([(1, "a b", "old", 7)], "doc_id long, text string, ids string, n_tokens int")
    (r,) = V.encode_documents(df, PATH).collect()
    assert r.n_tokens == len(r.ids) > 0
    assert MODEL.decode([MODEL.byte_id[0xFF]]) == "�" and MODEL.decode([]) == "" and MODEL.decode([1, 2]) == ""


def test_long_runs_take_few_bytes_a_character():
    import tracemalloc

    run = "中文字abc" * 50_000
    tracemalloc.start()
    ids = MODEL.viterbi(run)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert MODEL.decode(ids) == run and peak < 30 * len(run)
