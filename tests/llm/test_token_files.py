"""Token files: exact round trips, random access, and damage."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import queries
from tessera.llm import token_files as T
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, end=(2,)):
    """(doc_id, start, n_tokens, crc) by doc_id, NULL last; the order of rows with one doc_id is free."""
    t = Tokenizer.from_file(PATH)
    return [(i, [*t.encode(text or "", add_special_tokens=False).ids, *end]) for i, text in rows]


def check(got, rows):
    """The rows cover one sequence of ids in order of doc_id, and hold the ids of the rows' texts."""
    got = sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is None, i or 0))
    assert [r[1] for r in got] == (np.cumsum([0] + [r[2] for r in got])[:-1]).tolist()
    want = sorted((i is None, i or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in expected(rows))
    assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == want
    return got


def test_query(spark, documents):
    got = queries.op13_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check(got.collect(), [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_awkward_rows_in_several_files(spark, awkward, awkward_rows, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    made = T.write_tokens(awkward, folder, PATH, file_bytes=20_000).collect()
    assert len(made) > 1 and sum(r.n_docs for r in made) == len(awkward_rows)
    got = T.read_tokens(spark, folder).collect()
    check([r[:4] for r in got], [(r[0], r[1]) for r in awkward_rows])
    for r in got:
        assert len(r.ids) == r.n_tokens and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    # One document by its place: the file's own index and one frame.
    first = max(made, key=lambda r: r.n_docs)
    file = T.TokenFile(first.path, T._dictionary(folder))
    whole = list(file)
    assert all((file[k] == whole[k]).all() for k in reversed(range(len(file))))
    two = T.read_document(spark, folder, 7)
    assert sorted(len(x) for x in two) == sorted(r.n_tokens for r in got if r.doc_id == 7) and len(two) == 2
    assert T.read_document(spark, folder, 99) == []


def test_units_give_the_ids_of_the_whole_text():
    t = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as f:
        data = f.read()
    rules = T.Rules.of(data)
    assert rules == (True, ("<|endoftext|>",))
    encoder = T.Encoder(data, rules, None, remembered=32)
    texts = [
        "It's a test.Really, isn't it?  Yes!\n\n Well  then;no:a.b", "  lead and  trail  ", "a  b  c\x1c d\x85 e", "x <|endoftext|> y<|endoftext|>.z",
        "naïve café's 漢字 \U0001f600 ok, 12 ab3.c4 d'll.e", "", " ", "\n a", "we'll.they've! I'M,OK", "a" * 5000 + " " + "b. " * 100,
        "'dog 'tis x'y'z' ''s don'T", "é\u0301t 漢hello hello漢 µ x\xa0y \xa0 z", "end ", " start", "a \xa0\xa0b\n\nc\n d", "\n\n a", "tab\t tab \t tab", "a   b    c", "1st 2nd3 a1 b, (c) \"d'\"", "\u2019s it\u2019s \u00df1",
    ]
    ids = [np.frombuffer(x, "<u4").tolist() for x in encoder.batch(texts)]
    assert ids == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert encoder.batch(texts) == encoder.batch(texts)  # remembered


def test_a_part_is_looked_up_once_in_a_slice(monkeypatch):
    with open(PATH, "rb") as f:
        data = f.read()
    encoder, made = T.Encoder(data, T.Rules.of(data), 2, remembered=4), []
    make = encoder.parts.make
    encoder.parts.make = lambda part: made.append(part) or make(part)
    texts = [" ".join(f"{a}{b}" for a in "abcdef" for b in "uvwxyz") for _ in range(30)] + ["", "one"]
    ids = encoder.batch(texts)
    assert sorted(made) == sorted({p for t in texts for p in t.split(" ")})
    t = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    monkeypatch.setattr(T, "TEXT_AT_ONCE", 200)
    slices = list(T._slices(pa.array(texts)))
    assert [x for _, s in slices for x in s] == texts and len(slices) > 10
    assert [k for k, _ in slices] == np.cumsum([0] + [len(s) for _, s in slices])[:-1].tolist()
    assert [x for _, s in slices for x in encoder.batch(s)] == ids and list(T._slices(pa.array([], pa.string()))) == []


def test_other_tokenizer_and_no_end(spark, documents, tmp_path):
    path, folder = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "t")
    with open(path, "rb") as f:
        assert not T.Rules.of(f.read()).by_parts
    docs = documents.where("doc_id < 20")
    T.write_tokens(docs, folder, path, end_id=None)
    t = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.ids for r in T.read_tokens(spark, folder).collect()} == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in texts.items()}


def test_empty_table(spark, empty_docs, tmp_path):
    folder = str(tmp_path / "t")
    assert T.write_tokens(empty_docs, folder, PATH).count() == 0 and T.read_tokens(spark, folder).count() == 0


def test_files_of_failed_attempts_are_not_read_and_damage_is_found(spark, documents, tmp_path):
    folder = str(tmp_path / "t")
    docs = documents.where("doc_id < 40")
    (one,) = T.write_tokens(docs, folder, PATH).collect()
    with open(one.path, "rb") as f:
        data = f.read()
    with open(f"{folder}/files/000000-left-behind.tok", "wb") as f:
        f.write(data[:100])
    assert T.read_tokens(spark, folder, False).count() == docs.count()
    with pytest.raises(ValueError, match="dictionary"):
        T.TokenFile(one.path, b"another dictionary")
    with open(one.path, "wb") as f:
        f.write(data[:-60] + bytes([data[-60] ^ 1]) + data[-59:])
    with pytest.raises(ValueError, match="damaged"):
        T.TokenFile(one.path, T._dictionary(folder))
