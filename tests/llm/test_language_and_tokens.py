"""Language identification, conversation repair and tokenizer alignment."""

import hashlib
import json
import random
import uuid

import brute
import pytest
from pyspark.sql import functions as F

from duebook.llm import alignment, conversations, language, queries

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string, id string, kind int, chunk string, score string"


def stored(spark, tmp_path, name, rows, schema, parts=3):
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return folder


# --- language -----------------------------------------------------------------

WORDS = {
    "en": "the of and that was with which from this have been there their would about".split(),
    "fr": "les des que dans pour une avec être était cette leur tout mais comme nous".split(),
    "de": "der die und nicht eine für über schön ist auch werden noch ihre daß zwischen".split(),
}


def spoken(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randint(1, 30))) + rng.choice([".", " 12!", ""]), lang) for i, lang in ((i, rng.choice(list(WORDS))) for i in range(n))]


def test_language_agrees_with_plain_counts(spark):
    rows = spoken(300, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r.lang_pred for r in language.identify_language(df).collect()}
    assert got == brute.languages(rows, language.ORDER, language.HELD_OUT)


def test_language_of_odd_rows(spark):
    rows = spoken(200, 2)
    odd = {1000: None, 1001: "", 1002: " \n12 .;", 1003: "Über " * 200_000, 1004: "x", 1005: "漢字"}
    full = [(i, t, x, "e", 1, "e", "e") for i, t, x in rows] + [(i, t, None, None, None, None, None) for i, t in odd.items()]
    full += [(None, rows[0][1], "never", None, None, None, None), (1003, odd[1003], None, None, None, None, None)]
    df = spark.createDataFrame(full, DOCS).repartition(4)
    out = language.identify_language(df)
    assert out.columns == [*df.columns[:-1], "lang_pred", "score"]
    got = {}
    for r in out.collect():
        assert 0 <= r.score <= 1 and got.setdefault(r.doc_id, r.lang_pred) == r.lang_pred
    assert [got[i] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert {got[1004], got[1005]} <= set(WORDS) and "never" not in got.values()
    assert language.identify_language(df.limit(0)).count() == 0
    unlearned = language.identify_language(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unlearned.collect()} == {("und", 0.0)}


def test_language_slices_do_not_matter(spark, monkeypatch):
    text = " ".join(t for _, t, _ in spoken(40, 3))
    whole = sorted(b for bucket, _ in language._grams([text, "a", text]) for b in bucket.tolist())
    monkeypatch.setattr(language, "_SLICE", 17)
    parts = list(language._grams([text, "a", text]))
    assert sorted(b for bucket, _ in parts for b in bucket.tolist()) == whole and len(parts) > 100
    assert not any(len(b) for b, _ in language._grams(["", " 1"]))


def test_language_learns_from_no_held_out_row(spark, tmp_path):
    rows = spoken(400, 4)
    folder = stored(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string")
    before = sorted(map(tuple, queries.op11_language_id(spark, folder).collect()))
    held = {r[0] for r in before if r[1]}
    assert 60 < len(held) < 140
    moved = [(i, t, "xx" if i in held else x) for i, t, x in rows]
    folder = stored(spark, tmp_path, "documents", moved, "doc_id long, text string, lang string")
    assert sorted(map(tuple, queries.op11_language_id(spark, folder).collect())) == before
    right = {i: x for i, _, x in rows}
    assert sum(r[2] == right[r[0]] for r in before if r[1]) / len(held) > 0.95


# --- conversations ------------------------------------------------------------


def talk(n, seed):
    rng = random.Random(seed)
    texts = ["Hi.", "a b", "Q?", "  ", "", None, "Same.\n"]
    for c in range(n):
        for k in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "x"])
            yield c or None, rng.choice([None, k, k, k, rng.randint(0, 9)]), role, rng.choice([*texts, f"t {rng.random()}.", f"u {rng.random()}"])


def expected(rows):
    found = {}
    for row in brute.damaged(rows):
        found.setdefault(row[0], []).append(row)
    return {(c, *(brute.repaired(found[c]) if c in found else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()))) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("piece", [2, 1 << 16])
def test_conversations_against_all_repairs(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = list(talk(120, 5))
    rows += rows[:40]  # repeated rows
    folder = stored(spark, tmp_path, "conversations", rows, TURNS)
    got = [tuple(r) for r in queries.op12_conversation_repair(spark, folder).collect()]
    assert len(got) == 120 and set(got) == expected(rows)


def test_long_conversation(spark, monkeypatch):
    """Backpointers in many pieces, also inside a run of equal rows."""
    monkeypatch.setattr(conversations, "PIECE", 7)
    rows = [(1, k, ("user", "assistant")[k % 2], f"{k}.") for k in range(200)]
    rows += [(1, 17, "user", "again.")] * 20 + [(2, 0, "system", "S."), (2, 1, "assistant", "long " * 100_000 + ".")]
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({"edits": F.lit("x"), "place": F.lit(1), "mark": F.lit(2)})
    edited = conversations.repair(df)
    got = {r.conv_id: r for r in conversations.report(edited).collect()}
    for conv in (1, 2):
        assert tuple(got[conv])[1:] == brute.repaired([r for r in rows if r[0] == conv])
    kept = edited.where("conv_id = 2 and edit <> 'Delete'").orderBy("place").collect()
    assert [(r.role, r.edit, r.was) for r in kept] == [("system", "Keep", "system"), ("user", "Insert", None), ("assistant", "Keep", "assistant")]


def test_conversations_of_nothing(spark, tmp_path):
    folder = stored(spark, tmp_path, "conversations", [], TURNS)
    assert queries.op12_conversation_repair(spark, folder).count() == 0


# --- alignment ----------------------------------------------------------------


def reference_tokens():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(alignment.TOKENIZER_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.TOKENIZER_B)
    alphabet = alignment.byte_alphabet()

    def tokens_a(text):
        return [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]

    def tokens_b(text):
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            yield i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return tokens_a, lambda text: list(tokens_b(text))


ODD = [
    (None, None), (5, ""), (5, "a▁b"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"), (7, "\U0001f600" * 50 + "\U00010330" * 40),
    (7, " " * 100 + "\n\n\t" * 30), (8, "漢字" * 200), (8, "漢字" * 200), (9, "\x00 nul"), (10, "é it's"), (11, "x" * 5000), (None, "z"),
]


@pytest.mark.parametrize("chunk", [1 << 9, 1 << 22])
def test_alignment_against_all_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    rows = [(i, t) for i, t, _ in spoken(150, 6)] + ODD
    df = spark.createDataFrame([(i, t, None, "x", 1, "y", None) for i, t in rows], DOCS).repartition(3)
    found = alignment.link(df)
    want, counts = brute.linked(rows, *reference_tokens())
    assert sorted(map(tuple, found.documents.collect()), key=str) == sorted(want, key=str)
    assert {(r.a_id, r.b_id): r.n_docs for r in found.counts.collect()} == counts


def test_alignment_lists(spark):
    rows = alignment.align(spark.createDataFrame(ODD, "doc_id long, text string")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (sum(r.a_sizes), sum(r.b_sizes)) == (len(r.a_ids), len(r.b_ids)) and len(r.a_sizes) == len(r.b_sizes)


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    found = alignment.link(none)
    assert (found.documents.count(), found.counts.count(), alignment.align(none).count()) == (0, 0, 0)


def test_groups_with_many_tokens():
    """Groups of many tokens on both sides, repeated in a text and over texts."""
    pair = alignment.pair(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    rows = [(i, t * n) for i, (t, n) in enumerate([("ααβγ", 9), ("ქართული ", 5), ("ααβγ", 9), ("​‍", 6)])]
    x = pair.align([t for _, t in rows])
    assert x.a_sizes.max() > 1 and x.b_sizes.max() > 1
    c = alignment.chunk_of(x, pair)
    want, _ = brute.linked(rows, *reference_tokens())
    assert c.n_links.tolist() == [w[4] for w in want]
    assert pair.digests(x) == [w[7] for w in want]


def test_merging_by_rank_is_the_file_of_merges():
    """Why one library may stand for the other: ids rise with the merges, and every
    token is what its own characters merge into."""
    import tokenizers

    with open(alignment.TOKENIZER_A, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
    assert [vocab[m] for m in merged] == sorted(vocab[m] for m in merged)
    model = tokenizers.Tokenizer.from_file(alignment.TOKENIZER_A).model
    special = {t["content"] for t in spec["added_tokens"]}
    assert all(len(model.tokenize(t)) == 1 for t in vocab if t not in special)
