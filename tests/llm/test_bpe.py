import hashlib
import random

import pytest

from hallowgrid.llm.bpe import Codec, encode_records, token_digests

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def theirs():
    return tokenizers.Tokenizer.from_file(PATH)


def test_codec_agrees_with_the_public_library():
    lib, codec = theirs(), Codec(open(PATH, encoding="utf-8").read(), remember=50)
    rnd = random.Random(5)
    letters = "abcdeéñ ßİſ\n\t  's't'reN1٣Ⅷ漢😀.,!?́​\x85\x1c՘\U00010940"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(800)]
    texts += [t + "<|endoftext|>" + t for t in texts[:50]] + ["ab" * 20_000, "<|endoftext|>", " " * 500]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        got = list(codec.encode(t))
        assert got == want
        assert codec.decode(got) == lib.decode(want, skip_special_tokens=False) == t
    broken = [220, 162, 120]
    assert codec.decode(broken) == lib.decode(broken, skip_special_tokens=False)


def test_records_round_trip(awkward):
    rows = encode_records(awkward, PATH).collect()
    lib = theirs()
    texts = sorted((r.row_ord is None, r.row_ord or 0, r.desc or "") for r in awkward.collect())
    assert sorted((r.row_ord is None, r.row_ord or 0, r.decoded) for r in rows) == texts
    for r in rows:
        assert r.ids == lib.encode(r.decoded, add_special_tokens=False).ids
    digests = token_digests(awkward, PATH).collect()
    want = sorted((r.row_ord or -1, len(r.ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in r.ids)).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in rows)
    assert sorted((r.row_ord or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == want
    assert encode_records(awkward.limit(0), PATH).count() == token_digests(awkward.limit(0), PATH).count() == 0
