"""What Python workers hold while they encode."""

import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from vintora.llm import bpe, tokenfile
from vintora.llm.queries import vocabulary

ROLLUP = Path("/proc/self/smaps_rollup")
DOCUMENTS = "/root/testdata/check_s/documents.parquet"

WORKER = """
import re, sys
import pyarrow as pa
from vintora.llm import bpe

def held():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem): +(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

coder = bpe.opened(sys.argv[1])
before = most = held()
with open(sys.argv[2], "rb") as f:
    for batch in pa.ipc.open_stream(f):
        texts = [t or "" for t in batch.column(0).to_pylist()]
        for a, b in bpe.by_bytes([len(t) for t in texts], bpe.BATCH_BYTES):
            coder.encode(texts[a:b])
            most = max(most, held())
print(most - before)
"""


class Recorder:
    """A tokenizer that notes how many pieces it gets at a time."""

    def __init__(self, model):
        self.model, self.sizes = model, []

    def encode_batch_fast(self, pieces, **options):
        self.sizes.append(len(pieces))
        return self.model.encode_batch_fast(pieces, **options)


@pytest.mark.parametrize("kind, name", [(bpe.ByteBpe, "byte_bpe_50k.json"), (tokenfile.WordEncoder, "word_bpe_49k.json")])
def test_library_gets_a_slice_at_a_time(kind, name):
    coder = kind(vocabulary(name))
    coder.bare = Recorder(coder.bare)
    texts = [" ".join(f"w{k:x}q" for k in range(n, n + 3000)) for n in (0, 2000)]
    got = coder.encode(texts)[0].tolist()
    assert len(coder.bare.sizes) > 1 and max(coder.bare.sizes) <= 1000
    whole = [coder.__class__(vocabulary(name)).encode([t])[0].tolist() for t in texts]
    assert got == whole[0] + whole[1]


def test_odd_pieces_among_many():
    path = vocabulary("word_bpe_49k.json")
    coder, text = tokenfile.WordEncoder(path), "  ".join(["中文", "A1b2", "été", "</s>", ""] * 400 + [f"x{k}" for k in range(2500)])
    assert coder.encode([text])[0].tolist() == [*coder.model.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.skipif(not (ROLLUP.exists() and Path(DOCUMENTS).exists()), reason="needs the documents, and to read memory")
def test_memory_of_a_worker_that_encodes(tmp_path):
    """About 80 MB beside the vocabulary; it was 174 MB while whole batches of results and lists of ids stood."""
    rows = pq.read_table(DOCUMENTS, columns=["text"]).slice(0, 6000)
    with pa.ipc.new_stream(f"{tmp_path}/texts", rows.schema) as out:
        for batch in rows.to_batches(max_chunksize=1000):
            out.write_batch(batch)
    run = subprocess.run([sys.executable, "-c", WORKER, vocabulary("byte_bpe_50k.json"), f"{tmp_path}/texts"], cwd=Path(__file__).resolve().parents[2], env={k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}, capture_output=True, text=True, check=True, timeout=300)
    assert float(run.stdout) < 120
