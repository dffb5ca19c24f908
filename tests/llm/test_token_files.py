import zlib

import numpy as np
import pytest

from tests.llm.messy import documents
from tidemark.functions.session import fresh_dir
from tidemark.llm import queries, token_files
from tidemark.llm.tokens import Coder


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("size", [1, 7, 8, 1000])
def test_planes_round_trip(bits, size):
    ids = np.random.default_rng(size).integers(0, 1 << 32, size, dtype=np.uint64).astype("<u4")
    planes = token_files.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert token_files.from_planes(planes, size).tolist() == ids.tolist()


def test_checksums_join():
    data = bytes(range(256)) * 40
    for cut in (0, 1, 255, 4096, len(data)):
        assert token_files.crc_join(zlib.crc32(data[:cut]), zlib.crc32(data[cut:]), len(data) - cut) == zlib.crc32(data)


@pytest.mark.parametrize(("block", "bits"), [(16, False), (16, True), (100_000, False)])
def test_documents_come_back_in_order(spark, block, bits):
    docs, path, file = documents(spark), queries.tokenizer_path(), fresh_dir(spark, "test-files")
    token_files.write_token_files(docs, file, path, block_ids=block, bits=bits, partitions=4)
    coder, at, want = Coder(path), 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode())):
        ids = coder.encode(r.text or "") + b"\1\0\0\0"
        want.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = sorted(map(tuple, token_files.read_documents(spark, file).collect()), key=lambda r: r[1])
    assert got == want
    chunks = sorted(map(tuple, token_files.chunk_index(spark, file).collect()))
    assert [c[2] for c in chunks] == np.cumsum([0, *(c[3] for c in chunks)])[:-1].tolist() and sum(c[3] for c in chunks) == at
    assert sum(len(r.ids) for r in token_files.read_ids(spark, file).collect()) == at


def test_empty_table(spark):
    file = fresh_dir(spark, "test-files")
    token_files.write_token_files(documents(spark).limit(0), file, queries.tokenizer_path())
    assert token_files.read_documents(spark, file).collect() == []
