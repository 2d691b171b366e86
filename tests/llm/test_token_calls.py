"""What the token encoder asks of the library."""

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from helixframe.llm import tokens


class Counted:
    def __init__(self, library):
        self.library, self.made = library, 0

    def encode_batch_fast(self, texts, **more):
        self.made += len(texts)
        return self.library.encode_batch_fast(texts, **more)

    def __getattr__(self, name):
        return getattr(self.library, name)


def rows_of(coder, texts):
    return [x.tolist() for ids, counts in coder.column(pa.array(texts)) for x in np.split(ids, np.cumsum(counts)[:-1])]


TEXTS = [" ".join(f"w{i}élan{i * 7919 % 1000}'s" for i in range(3000)), "", None, "\n\n  \t x y \U0001f600é́ ", "a" * 5000, "\x00 \x00\x00", "you'll've  don't\r\n"]


def test_pretokens_share_calls():
    path = public_tokenizers.path(tokens.TOKENIZER)
    library, coder = Tokenizer.from_file(path), tokens.Encoder(path)
    coder.library = Counted(coder.library)
    assert rows_of(coder, TEXTS) == [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert len(coder.keys) > 3000
    assert coder.library.made <= len(coder.keys) // tokens.AT_ONCE + 1


def test_bytes_that_do_not_add_up():
    path = public_tokenizers.path(tokens.TOKENIZER)
    library, coder = Tokenizer.from_file(path), tokens.Encoder(path)
    coder.id_bytes[:] = 1
    assert rows_of(coder, TEXTS) == [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
