"""Token files, byte-level BPE and token counts against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyhouse.llm import byte_bpe, pieces, token_counts, token_files

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(JSON)
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_bpe.load_ranks(RANKS).ranks)


def little(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'strevmld09.,éÀ²×ÿ")), max_size=60))
def test_any_text_is_encoded_as_the_libraries_do(text):
    vocabulary = byte_bpe.load_ranks(RANKS)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=vocabulary.ranks)
    ids = byte_bpe.encode_text(text, RANKS)
    assert ids == encoding.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()
    assert "".join(pieces.split(text)) == text


def test_the_end_token_in_a_text_is_ordinary_text(tokenizer):
    encoder, size = token_files.load_encoder(JSON)
    text = "a<|endoftext|> b"
    assert encoder.encode(text) == little(tokenizer.encode(text, add_special_tokens=False).ids)
    assert size == 50257


class NoPasses:
    """A tokenizer that refuses to run all its steps over a text."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def __getattr__(self, name):
        if name.startswith("encode"):
            raise AssertionError("a pass through all steps")
        return getattr(self.tokenizer, name)


def test_a_new_piece_is_given_to_the_model_alone(tokenizer):
    encode = token_files._piece_encoder(NoPasses(tokenizer))
    for piece in [chr(c) for c in range(0x250)] + [" unheardofword", " 1234567890", "漢字漢字", "😀", "\n\n \t", " …—«»", "\xad", ""]:
        assert encode(piece) == little(tokenizer.encode(piece, add_special_tokens=False).ids)


def test_a_tokenizer_with_further_steps_runs_them():
    from tokenizers import normalizers

    lowering = Tokenizer.from_file(JSON)
    lowering.normalizer = normalizers.Lowercase()
    encode = token_files._piece_encoder(lowering)
    assert encode("Word") == encode("word") == little(lowering.encode("word", add_special_tokens=False).ids)


def test_pieces_that_are_not_kept_change_nothing():
    texts = ["some words and some words", "other words " * 40, "x" * 500, ""]
    encode = lambda piece: little([len(piece)])
    small, large = pieces.PieceEncoder(encode, capacity=2, longest=3), pieces.PieceEncoder(encode)
    for _ in range(2):
        assert [small.encode(t) for t in texts] == [large.encode(t) for t in texts]
    assert len(small) <= 2


def test_appends_and_edits_equal_a_new_encoding():
    vocabulary, draw = byte_bpe.load_ranks(RANKS), random.Random(4)
    letters = "abcdeinorst é漢"
    for _ in range(60):
        text = "".join(draw.choice(letters) for _ in range(400)).encode()
        cut = draw.randrange(len(text))
        grown = byte_bpe.Encoding(vocabulary, text[:cut])
        grown.append(text[cut:])
        whole = byte_bpe.Encoding(vocabulary, text)
        assert grown.tokens() == whole.tokens()
        assert grown.tokens(cut) == byte_bpe.Encoding(vocabulary, text[:cut]).tokens()
        start = draw.randrange(len(text))
        stop, new = min(len(text), start + draw.randrange(6)), draw.choice([b"", b"e", b"there", "字".encode()])
        steps = whole.replace(start, stop, new)
        assert bytes(whole.data) == text[:start] + new + text[stop:]
        assert whole.tokens() == byte_bpe.Encoding(vocabulary, bytes(whole.data)).tokens()
        assert whole.tokens(start) == byte_bpe.Encoding(vocabulary, text[:start]).tokens()
        assert steps <= len(whole.data)


def test_an_edit_is_encoded_again_nearby_only():
    vocabulary = byte_bpe.load_ranks(RANKS)
    encoding = byte_bpe.Encoding(vocabulary, b"the quick brown fox " * 200)
    assert encoding.replace(1000, 1001, b"xy") < 200


def test_documents_are_encoded_and_decoded(spark, frame, odd_rows, reference):
    found = byte_bpe.encode_documents(frame(odd_rows), RANKS,
                                      outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"))
    rows = [tuple(r) for r in found.collect()]
    expected = []
    for doc_id, text in odd_rows:
        ids, data = reference.encode_ordinary(text or ""), (text or "").encode()
        expected.append((doc_id, little(ids), len(ids), hashlib.sha256(little(ids)).hexdigest(),
                         hashlib.sha256(data).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(rows, key=key) == sorted([(a, bytearray(b), *c) for a, b, *c in expected], key=key)
    decoded = {bytes(r.decoded) for r in byte_bpe.decode_documents(found, RANKS).collect()}
    assert decoded == {(t or "").encode() for _, t in odd_rows}
    assert byte_bpe.encode_documents(frame([]), RANKS).count() == 0


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_files_are_where_spark_has_the_folder(spark, frame, tmp_path, form):
    folder = form.format(tmp_path / "shards")
    manifest = token_files.write_shards(frame([(1, "a"), (2, "b")]), JSON, folder)
    shards = [r.shard for r in manifest.collect()]
    assert shards and all(s.startswith(f"file://{tmp_path}/shards/") for s in shards)
    assert all((tmp_path / "shards" / s.rsplit("/", 1)[1]).is_file() for s in shards)
    assert spark.read.format("binaryFile").load(f"{folder}/*.arrow").count() == 2 * len(shards)
    assert token_files.read_documents(token_files.read_manifest(spark, folder)).count() == 2


@pytest.mark.parametrize("length, per_batch", [(8, 2), (2048, 64)])
def test_files_hold_all_ids_in_order(spark, frame, odd_rows, tokenizer, tmp_path, length, per_batch):
    rows = [(i, t) for i, t in odd_rows if i is not None]
    folder = str(tmp_path / "shards")
    manifest = token_files.write_shards(frame(rows), JSON, folder, sequence_length=length, sequences_per_batch=per_batch)
    found = sorted(tuple(r) for r in token_files.read_documents(manifest).collect())
    expected, at, flat = [], 0, []
    for doc_id, text in sorted((i, t or "") for i, t in rows):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        expected.append((doc_id, at, len(ids), zlib.crc32(little(ids))))
        at += len(ids)
        flat += ids
    assert found == sorted(expected)
    stored, masks = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r.base):
        shard = token_files.Shard(row.shard)
        ids = shard.ids(0, row.n_tokens)
        assert row.base == len(stored)
        stored += ids.tolist()
        n = sum(shard.batch(i)[0].shape[0] for i in range(shard.file.num_record_batches))
        masks += sum(int(shard.sequence(i)[1].sum()) for i in range(n))
        sequence, mask = shard.sequence(n - 1)
        assert len(sequence) == len(mask) == length and not sequence[~mask].any()
        assert not sequence.flags.owndata and not sequence.flags.writeable
    assert stored == flat and masks == len(flat)


def test_added_tokens_in_texts_are_what_the_unchanged_library_gives(spark, frame, tmp_path):
    unchanged = Tokenizer.from_file(JSON)
    rows = [(1, "a<|endoftext|> b"), (2, "<|endoftext|>"), (3, "x  <|endoftext|>\n<|endoftext|>'s é"), (4, "<|endoftext"),
            (5, ""), (6, None), (7, "plain words")]
    ids = {i: unchanged.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    assert ids[1] == [64, 50256, 275]
    lengths = token_counts.encoded_lengths(frame(rows), JSON).collect()
    assert {r.doc_id: r.n_tokens for r in lengths} == {i: len(x) for i, x in ids.items()}
    manifest = token_files.write_shards(frame(rows), JSON, str(tmp_path / "added"))
    found, at = sorted(tuple(r) for r in token_files.read_documents(manifest).collect()), 0
    for row, (i, x) in zip(found, ids.items(), strict=True):
        assert row == (i, at, len(x) + 1, zlib.crc32(little(x + [0])))
        at += len(x) + 1


def test_files_of_an_empty_table_and_null_ids(spark, frame, tmp_path):
    manifest = token_files.write_shards(frame([]), JSON, str(tmp_path / "none"))
    assert token_files.read_documents(manifest).count() == 0
    with pytest.raises(Exception, match="without id"):
        token_files.write_shards(frame([(None, "x")]), JSON, str(tmp_path / "bad"))


def test_histogram_answers_every_limit(spark, frame, odd_rows, tokenizer):
    lengths = token_counts.encoded_lengths(frame(odd_rows), JSON)
    n = np.array([len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in odd_rows])
    assert sorted(r.n_tokens for r in lengths.collect()) == sorted(n.tolist())
    histogram = token_counts.length_histogram(lengths).cache()
    rows = histogram.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(n.tolist()))
    for r in rows:
        size = r.n_tokens
        assert r.n_docs == (n == size).sum() and r.docs_at_least == (n >= size).sum()
        assert r.tokens_at_least == n[n >= size].sum() and r.cut_docs == (n > size).sum()
        assert r.kept_tokens == np.minimum(n, size).sum() and r.quantile == pytest.approx((n <= size).mean())
    for r in token_counts.at_limit(histogram, [1, 7, 1024]).collect():
        assert (r.n_docs, r.n_tokens) == (len(n), n.sum())
        assert (r.cut_docs, r.kept_tokens) == ((n > r.limit).sum(), np.minimum(n, r.limit).sum())
    assert token_counts.quantile(histogram, 0.5) == np.sort(n)[(len(n) + 1) // 2 - 1]
    empty = token_counts.length_histogram(lengths.limit(0))
    assert empty.count() == 0 and token_counts.quantile(empty, 0.5) is None
