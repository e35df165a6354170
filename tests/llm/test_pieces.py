"""SentencePiece encoding and decoding against the library itself."""

import hashlib
import random

import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.llm import pieces, store
from shopflow.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
MODEL = pieces.read_model(PATH)
OURS, LIBRARY = pieces.loaded(MODEL), sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = ["", " ", "  ", "\u2581", "a\u2581b", " lead", "tail ", "<s>", "</s><unk><0x0A>", "\n\n\tx\r\n", "\0", "a" * 500,
         " " * 90, "12345 6,789.01", "\u4f60\u597d\u4e16\u754c", "\U0001f600\U0001f468\u200d\U0001f469", "e\u0301", "\ufffd",
         "f(x) = _a.b['c'];  // d", "\u00b2. \u00b2.x", "WWW.X", "don't"]


@pytest.mark.parametrize("text", TEXTS)
def test_special_texts(text):
    assert OURS.encode(text) == LIBRARY.encode(text)
    assert OURS.decode(OURS.encode(text) + [2]) == LIBRARY.decode(LIBRARY.encode(text, add_eos=True))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abet hinTHE \n.,'1\u2581\u00e9\u00b2"), st.characters(exclude_categories=["Cs"])),
               max_size=80))
def test_any_text(text):
    assert OURS.encode(text) == LIBRARY.encode(text)
    assert OURS.decode(OURS.encode(text)) == LIBRARY.decode(LIBRARY.encode(text))


def test_runs_of_vocabulary_pieces():
    rng = random.Random(5)
    words = list(OURS.id)
    for _ in range(2000):
        text = "".join(rng.choice(words) for _ in range(rng.randrange(1, 25))).replace("\u2581", rng.choice([" ", "\u2581"]))
        assert OURS.encode(text) == LIBRARY.encode(text), text


def test_cuts_do_not_change_a_text():
    rng = random.Random(6)
    words = list(OURS.id)
    for _ in range(500):
        text = "\u2581" + "".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))
        assert "".join(OURS.cut.findall(text)) == text
        assert OURS.split(text) == [p for cut in OURS.cut.findall(text) for p in OURS.split(cut)]


def test_backtracking_equals_the_merge_rules_on_long_cuts():
    rng = random.Random(7)
    for alphabet in ("ab", "thein", "aeinorst", "=-_*#"):
        for _ in range(60):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120)))
            assert OURS.split(text) == OURS.merges(text)[0]


def test_any_ids_decode_as_the_library_does():
    rng = random.Random(8)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), OURS.id["\u2581"], 0, 1, 2])
               for _ in range(rng.randrange(9))]
        assert OURS.decode(ids) == LIBRARY.decode(ids), ids


def test_frames(spark):
    rows = [(1, None, "x", 9), (2, "", "y", 9), (2, "", "y", 9), (None, "a b", None, None), (5, "long word " * 40000, "z", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int").repartition(3)
    got = pieces.decoded(pieces.encoded(df, MODEL), MODEL)
    assert got.columns == ["doc_id", "text", "decoded", "n_tokens", "ids"]
    want = [(i, t, t, n, None if t is None else LIBRARY.encode(t, add_eos=True)) for i, t, _, n in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert pieces.decoded(pieces.encoded(df.limit(0), MODEL), MODEL).count() == 0


@pytest.mark.parametrize("made", [lambda df: pieces.encoded(df, MODEL),
                                  lambda df: pieces.decoded(df.withColumn("ids", F.array(F.lit(5))), MODEL)])
def test_workers_get_small_batches_where_the_session_sets_none(spark, made):
    session = spark.newSession()  # Spark's defaults: up to 10000 rows
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        session.conf.unset(f"spark.sql.execution.arrow.{key}")

    @F.arrow_udf("struct<rows: long, bytes: long>")
    def met(texts: pa.Array) -> pa.Array:
        return pa.array([{"rows": len(texts), "bytes": texts.nbytes}] * len(texts))

    def largest(n: int, text) -> tuple:
        df = session.range(0, n, 1, 1).select(text.alias("text"))
        made(df)
        return tuple(df.select(met("text").alias("m")).agg(F.max("m.rows"), F.max("m.bytes")).first())

    assert largest(2500, F.lit("a b"))[0] == store.BATCH_ROWS
    assert largest(400, F.repeat(F.lit("word "), 20000))[1] <= store.BATCH_BYTES + 200_000  # 40 MB in all


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(MODEL)
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.Pieces(proto.SerializeToString())
    proto.ParseFromString(MODEL)
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        pieces.Pieces(proto.SerializeToString())


def test_query(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for i, t in zip(docs.doc_id, docs.text.fillna("")):
        ids = LIBRARY.encode(t, add_eos=True)
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    got = [tuple(r) for r in QUERIES["op12_sentencepiece"](spark, SMALL).collect()]
    assert set(got) == want and len(got) == len(docs)
