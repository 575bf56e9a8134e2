import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicspark.llm import pieces as P

from .conftest import documents

TEXTS = ["", None, "  two  spaces\t\n x ", "a▁b ▁ ▁▁x", "   ", "\n\n", "日本語 😀 text\x00", "é" * 3000, "x" * 5000, "<s> </s> <unk> <0x41>", "The and for this that with are"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(P.MODEL, "rb") as f:
        return P.Pieces(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeTh é\n 日😀.,"), max_size=60))
def test_without_dropout_it_is_the_librarys_encoding(vocabulary, library, text):
    assert np.frombuffer(vocabulary.encode(text, P.Kept(vocabulary)), np.int32).tolist() == library.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60), st.integers(0, 5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_any_segmentation_decodes_to_the_text(vocabulary, text, seed, rate):
    raw = vocabulary.encode(text, P.Kept(vocabulary, seed, int(rate * 2**32)))
    assert vocabulary.decode(np.frombuffer(raw, np.int32).tolist()) == text


def test_short_and_long_agendas_agree(vocabulary):
    for limit in (0, 1 << 30, 3 << 30):
        for word in ("▁transformation", "▁▁▁", "tionéeux", "a"):
            assert vocabulary._short(word, 12345, limit) == vocabulary._long(word, 12345, limit)


def test_encode_and_decode_frames(spark):
    docs = documents(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "null id")])
    out = P.encode_texts(docs, 0.3, seed=1, carry=("doc_id", "key")).cache()
    assert out.filter("restored").count() == len(TEXTS) + 2
    back = {(r["doc_id"], r["text"]) for r in P.decode_ids(out).collect()}
    assert back == {(i, t or "") for i, t in enumerate(TEXTS)} | {(None, "null id")}
    twice = [sorted(tuple(r["ids"]) for r in x.collect()) for x in (out, P.encode_texts(docs.repartition(3), 0.3, seed=1))]
    assert twice[0] == twice[1]
    other = sorted(tuple(r["ids"]) for r in P.encode_texts(docs, 0.3, seed=2).collect())
    assert other != twice[0]


def test_dropout_lengthens_and_streams_differ(spark):
    docs = documents(spark, [(i, "information transformation notwithstanding understanding " * 3) for i in range(40)])
    total = lambda **k: {tuple(r["ids"]) for r in P.encode_texts(docs, **k).collect()}
    plain, dropped, streams = total(dropout=0.0), total(dropout=0.3), total(dropout=0.3, streams=8)
    assert len(plain) == len(dropped) == 1 < len(streams) <= 8
    assert len(next(iter(plain))) < len(next(iter(dropped)))
    assert {len(set(x)) > 0 for x in total(dropout=1.0)} == {True}


def test_ids_that_are_no_text(spark):
    rows = spark.createDataFrame([(1, [5, 99999, -1, 1, 2]), (2, None), (3, []), (4, [None])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in P.decode_ids(rows).collect()}
    assert got == {1: "\x02", 2: None, 3: "", 4: ""}


def test_empty_table(spark, empty):
    assert P.encode_texts(empty).count() == 0 and P.decode_ids(P.encode_texts(empty)).count() == 0


def test_documents_come_back_whole(spark, sf_docs):
    out = P.encode_texts(sf_docs, 0.1, seed=3)
    back = P.decode_ids(out).join(sf_docs.select("doc_id", F.col("text").alias("want")), "doc_id")
    assert back.filter("text = want").count() == sf_docs.count()


def test_every_occurrence_draws_its_own_segmentation(vocabulary, library):
    text = "information transformation notwithstanding understanding " * 30 + "x" * 200 + " a▁b  ▁"
    drawn = P.Drawn(vocabulary, 0.1)

    def ids(key, rate=0.1, text=text):
        drawn.rate = rate
        return drawn.encode([text], [key])[0].tolist()

    plain = text.split(" a▁")[0]
    assert ids(1, 0.0, plain) == library.encode(plain) and len(ids(1, 1.0)) > len(text)
    assert ids(1) == ids(1) != ids(2) and vocabulary.decode(ids(3)) == text
    # The draws are those of one trial after another.
    turns, many = drawn.skips(7, 0), []
    while not many or many[-1] < 10**5:
        many.append(next(turns))
    assert len(set(many)) == len(many) and abs(len(many) / many[-1] - 0.1) < 0.005
    # Every occurrence by itself: all skipped candidates at once, the agenda from the start.
    text += " 日é😀x " * 20
    raw, place = b"", 0
    for number, part in enumerate(text.split(P.SPACE)):
        if number:
            raw, place = raw + np.array([vocabulary.bytes[b] for b in P.SPACE.encode()], np.int32).tobytes(), place + 1
        for segment in vocabulary.cut.findall(("" if number else P.SPACE) + part.replace(" ", P.SPACE)):
            raw += vocabulary._raw(vocabulary._long(segment, 0, 0, P.Turns(drawn.skips(5, place))))
            place += 1
    assert np.frombuffer(raw, np.int32).tolist() == ids(5, text=text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeTh é\n 日😀.,▁"), max_size=60), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_agendas_side_by_side_are_those_of_one_segment(vocabulary, text, rate):
    drawn = P.Drawn(vocabulary, rate)
    got = drawn.encode([text], [9])[0].tolist() if text else []
    want = b""
    for place, segment in enumerate(drawn.segments(text) if text else []):
        if segment:
            want += vocabulary.merge_without(segment, drawn.skips(9, place))[0]
        else:
            want += np.array([vocabulary.bytes[b] for b in P.SPACE.encode()], np.int32).tobytes()
    assert got == np.frombuffer(want, np.int32).tolist()


def test_batches_and_forgetting_change_nothing(vocabulary, sf_docs, monkeypatch):
    texts = [r["text"] or "" for r in sf_docs.limit(60).collect()] + ["", "y" * 4000, "a b " * 2000]
    keys = list(range(len(texts)))
    whole, sizes = P.Drawn(vocabulary, 0.2).encode(texts, keys)
    monkeypatch.setattr(P, "KEPT", 50)
    drawn, parts = P.Drawn(vocabulary, 0.2), []
    for i in range(0, len(texts), 7):
        flat, some = drawn.encode(texts[i : i + 7], keys[i : i + 7])
        assert some.tolist() == sizes[i : i + 7].tolist()
        parts.append(flat)
    assert np.concatenate(parts).tolist() == whole.tolist()
    ends = np.cumsum([0, *sizes])
    assert [vocabulary.decode(whole[lo:hi].tolist()) for lo, hi in zip(ends, ends[1:])] == texts


def test_a_task_looks_at_a_megabyte_of_text_at_a_time(vocabulary, monkeypatch):
    met, encode = [], P.Drawn.encode
    monkeypatch.setattr(P.Drawn, "encode", lambda self, texts, keys: met.append(sum(map(len, texts))) or encode(self, texts, keys))
    text = "a few words of no great weight " * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array([text] * 100), pa.array(range(100))], names=["c0", "text", "stream"])
    with open(P.MODEL, "rb") as file:
        proto = type("Sent", (), {"value": file.read()})
    out = list(P._encode(proto, 0.1, 7, 0)(iter([batch])))
    assert sum(met) == 100 * len(text) and max(met) <= 1 << 20
    assert [i for x in out for i in x["c0"].to_pylist()] == list(range(100)) and all(r for x in out for r in x["restored"].to_pylist())


def test_the_query_and_the_pipeline_segment_words_anew(spark, tmp_path):
    import corpus_pipeline

    docs = documents(spark, [(i, "information transformation notwithstanding understanding " * 3) for i in range(40)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (P.op7_pieces(spark, str(tmp_path)), corpus_pipeline.encoding(spark, docs, str(tmp_path))):
        first, again = (sorted((r["doc_id"], tuple(r["ids"])) for r in x.filter("restored").collect()) for x in (out, out.repartition(3)))
        assert first == again and len(first) == 40 and len({x for _, x in first}) > 30
