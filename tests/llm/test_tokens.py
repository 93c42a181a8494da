"""Token files: ids as the library gives them, positions, order, and what ORC leaves unread."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from chainlytics.llm import tokens as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return T.load(PATH)


def test_pieces_are_those_of_the_tokenizer(tokenizer):
    memo, rng = T.memo_of(PATH), random.Random(3)
    letters = [chr(c) for c in range(0x250)] + list("中é́😀１²<|>") + ["<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) if rng.random() < 0.5 else rng.choice(" \n\t\x1c\x85\xa0a's1't") for _ in range(rng.randint(0, 12)))
        got = b"".join(map(memo.__getitem__, T.SPLIT.findall(text))) if T.plain(text) else memo.whole(text)
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def want(tokenizer, rows):
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((str(doc), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out)


def test_positions_in_id_order_from_the_files(spark, root, tokenizer):
    rng = random.Random(5)
    rows = [(n, " ".join(rng.choice(["the", "Ünd", "x1", "<|endoftext|>", "中"]) for _ in range(rng.randint(0, 40)))) for n in rng.sample(range(10_000), 150)]
    rows += [(None, "no id"), (20_000, None), (20_001, ""), (20_002, "same"), (20_002, "same"), (20_002, "other"), (20_003, "long " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    T.write_ids(docs, f"{root}/ids", PATH, 2, files=4)
    stored = T.read_ids(spark, f"{root}/ids")
    got = [tuple(r) for r in T.positions(stored).orderBy("start").collect()]
    assert sorted((str(d), n, c) for d, _, n, c in got) == want(tokenizer, rows)
    ids = [d for d, *_ in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert [s for _, s, *_ in got] == np.r_[0, np.cumsum([n for *_, n, _ in got])][:-1].tolist()
    one = stored.where("doc_id = 20001").select("ids")
    assert one.collect()[0][0] == [2]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,20001)]" in one._jdf.queryExecution().toString()


def test_bloom_filters_and_indexes_are_in_the_files(spark, root):
    from pathlib import Path

    docs = spark.createDataFrame([(n, "a b") for n in range(3000)], "doc_id bigint, text string")
    T.write_ids(docs, f"{root}/ids", PATH, 2, files=2)
    files = list(Path(f"{root}/ids").glob("*.orc"))
    assert len(files) == 2
    from pyarrow import orc

    assert all(orc.ORCFile(f).row_index_stride == T.INDEX_ROWS for f in files)


def test_an_empty_table(spark, root):
    T.write_ids(spark.createDataFrame([], "doc_id bigint, text string"), f"{root}/ids", PATH, 2)
    assert T.positions(T.read_ids(spark, f"{root}/ids")).count() == 0
