"""Archives of large records."""

import random

import pytest
import zstandard

from corvane.llm import warc


@pytest.mark.parametrize("many,size", [(24, 1 << 20), (190, 128 << 10), (6, 4 << 20)])
def test_files_of_large_records_have_a_dictionary(many, size):
    rng = random.Random(7)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(2000)]
    part = [" ".join(rng.choices(vocab, k=4000)) for _ in range(many)]
    records = [warc.record(i, f"http://h/{i}", (p * (size // len(p) + 1))[:size].encode(), "D", "response", None) for i, p in enumerate(part)]
    data = warc.archive(records)
    n = int.from_bytes(data[4:8], "little")
    assert n > 0
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + n]))
    at, back = 8 + n, []
    while at < len(data):
        end = warc.frame_end(data, at)
        back.append(reader.decompress(data[at:end]))
        at = end
    assert back == records
