import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from trajspark.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_added_tokens_are_found_as_in_a_plain_call(spark, tmp_path):
    texts = ["abc <|endoftext|> def", "abc", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "<|endo", "ftext|> no", "É <|endoftext|", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, start, want = Tokenizer.from_file(VOCABULARY), 0, []
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op10_huffman_files"](spark, str(tmp_path)).collect()) == want
