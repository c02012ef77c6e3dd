import collections
import hashlib
import itertools
import json
import os
import random
import types
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stemma.llm import bpe, media, packing
from tests.llm.tables import ROWS, documents, empty

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# ---------- media ----------


@given(st.binary(max_size=400))
def test_image_round_trip(data):
    payload = media.padded(data)
    assert len(payload) % 64 == 0 and payload and payload.startswith(data) and len(payload) - len(data) <= 64
    assert media.decode_image(media.encode_image(payload)) == payload


def test_damaged_image_raises():
    image = bytearray(media.encode_image(media.padded(b"abc")))
    image[45] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        media.decode_image(bytes(image))


def test_media_round_trip(spark):
    got = media.media_round_trip(documents(spark)).collect()
    want = []
    for i, t in ROWS:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        want.append((str(i), len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
    assert sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == sorted(want)
    assert len({(r.media_sha256, r.feature) for r in got}) == len({(t or "") for _, t in ROWS})
    assert media.media_round_trip(empty(spark)).count() == 0


def test_identifiers_of_any_type(spark):
    for kind, ids in (("string", ["a", "", None, "é"]), ("int", [1, 2, None, -4])):
        docs = spark.createDataFrame([(i, "t") for i in ids], f"doc_id {kind}, text string")
        got = media.media_round_trip(docs)
        assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in got.collect())


def test_media_columns_are_those_of_a_plain_version(spark):
    """The stored form read by another decoder, its digest, and the feature of its samples."""
    got = {r.payload_sha256: r for r in media.media_round_trip(documents(spark)).collect()}
    for _, t in ROWS:
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        lines = b"".join(b"\0" + payload[i : i + 64] for i in range(0, len(payload), 64))
        part = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
        head = (64).to_bytes(4, "big") + (len(payload) // 64).to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
        png = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines, 1)) + part(b"IEND", b"")
        r = got[hashlib.sha256(payload).hexdigest()]
        assert (r.media_bytes, r.media_sha256) == (len(png), hashlib.sha256(png).hexdigest())
        mean = sum(payload) / len(payload)
        dev = (sum((x - mean) ** 2 for x in payload) / len(payload)) ** 0.5
        counts = collections.Counter(payload)
        entropy = -sum(n / len(payload) * np.log2(n / len(payload)) for n in counts.values())
        rows = [payload[i : i + 64] for i in range(0, len(payload), 64)]
        same = sum(a == b for a, b in zip(rows, rows[1:], strict=False)) / max(1, len(rows) - 1)
        found = dict(x.split("=") for x in r.feature.split()[2:])
        assert r.feature.startswith(f"grey8 64x{len(rows)} ") and all(abs(float(found[k]) - v) < 2e-4 for k, v in (("mean", mean), ("dev", dev), ("entropy", entropy), ("same", same)))


def test_archives_by_ranges_and_retries(spark, tmp_path):
    docs = documents(spark)
    path = str(tmp_path / "packs")
    assert media.write_archives(docs, path, archive_bytes=500) == len(ROWS)
    whole = {(r.doc_id, bytes(r.media)) for r in media.read_archives(spark, path).collect()}
    for size in (150, 333, 1 << 20):
        assert {(r.doc_id, bytes(r.media)) for r in media.read_archives(spark, path, range_bytes=size).collect()} == whole
    assert media.write_archives(docs, path, archive_bytes=500) == len(ROWS)  # a repeated task replaces its files
    assert media.read_archives(spark, path).count() == len(ROWS)
    name = sorted(n for n in os.listdir(path) if n.endswith(".pack"))[0]
    with open(os.path.join(path, name), "r+b") as f:
        f.seek(60)
        byte = f.read(1)
        f.seek(60)
        f.write(bytes([byte[0] ^ 1]))
    bad = media.read_archives(spark, path, tries=2, on_error="report")
    described = media.describe(bad).collect()
    assert len(described) == len(ROWS) and [r.n_bytes for r in described if r.media_sha256 is None] == [None]
    assert bad.where("error IS NOT NULL").count() == 1 and bad.where("error IS NULL").count() == len(ROWS) - 1
    with pytest.raises(Exception, match="damaged member"):
        media.read_archives(spark, path, tries=1).collect()


def test_member_is_retried_by_itself(tmp_path, monkeypatch):
    reader = media.ArchiveReader({"path": str(tmp_path)})
    fs, root = media._store(str(tmp_path))
    archive = media._Archive(fs, f"{root}/a.pack")
    for i in range(3):
        archive.add(str(i), 3, media.encode_image(media.padded(b"abc")))
    archive.close()
    seen, real = collections.Counter(), media.ArchiveReader._member

    def flaky(self, fs, path, at, stop, handle=None):
        seen[at] += 1
        assert (handle is not None) == (seen[at] == 1)  # the range's handle first, then a fresh one
        if at and seen[at] < 3:
            raise OSError("gone")
        return real(self, fs, path, at, stop, handle)

    monkeypatch.setattr(media.ArchiveReader, "_member", flaky)
    (part,) = reader.partitions()
    assert [k for b in reader.read(part) for k in b.column(0).to_pylist()] == ["0", "1", "2"]
    assert sorted(seen.values()) == [1, 3, 3]


# ---------- tokens ----------

MACHINE = bpe.transducer(bpe.default_vocabulary())


def own(text):
    return np.frombuffer(b"".join(MACHINE.encode(text)), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "\n", "\t", "é", "ß", "the", "ing", "　", "\x1c", "\x85", "\xa0", "!", "1", "😀", "====", "    ", "'s", "'", "中", "\x00", "tion"]), max_size=60).map("".join))
def test_ids_are_the_library_s(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert own(text) == want
    assert "".join(MACHINE.decode(MACHINE.encode(text))) == LIBRARY.decode(want, skip_special_tokens=False)


def test_new_words_cost_no_merging_and_no_pattern_of_properties(monkeypatch):
    def never(*_):
        raise AssertionError("the slow way")

    machine = bpe.Transducer(bpe.default_vocabulary())
    monkeypatch.setattr(machine, "_merged", never)
    monkeypatch.setattr(machine, "split", types.SimpleNamespace(findall=never))
    draw = random.Random(5)
    parts = ["on", "the", "er", "ción", "é", "ß", "eux", "chpf", "aa", "中", "и", "“", "7", "'ll"]
    text = " ".join("".join(draw.choices(parts, k=draw.randint(1, 7))) for _ in range(3000))
    assert np.frombuffer(b"".join(machine.encode(text)), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_plain_pattern_splits_like_the_pattern():
    plain = bpe.plain_split()
    every = [chr(c) for c in range(bpe.PLAIN_LAST + 1) if not 0xD800 <= c <= 0xDFFF]
    for form in ("{}", "a{}b", " {}{} x", "1 {}\n", "!{} {}'s", "'{}"):
        text = "".join(form.replace("{}", c) for c in every)
        assert plain.findall(text) == MACHINE.split.findall(text)
    draw = random.Random(6)
    signs = list("ab1 \n\t'!é中\x1c\x85\xa0\u2028\u3000²Ⅷ") + ["'s", "'ll", "'re", "'S", "  "]
    for _ in range(5000):
        text = "".join(draw.choices(signs, k=draw.randint(0, 14)))
        assert plain.findall(text) == MACHINE.split.findall(text)
    assert own("a😀b 𝒳𝒴 𐄇é") == LIBRARY.encode("a😀b 𝒳𝒴 𐄇é", add_special_tokens=False).ids


def test_borders_are_judged_as_the_merges_do(tmp_path):
    draw = random.Random(7)
    tokens = [i for i in range(50_256) if len(MACHINE.bytes[i]) < 12]
    runs = [i for i in tokens if len(MACHINE.bytes[i]) > 1 and len(set(MACHINE.bytes[i])) == 1]
    pairs = [(draw.choice(tokens), draw.choice(tokens)) for _ in range(5000)] + [(a, b) for a in runs for b in runs if MACHINE.bytes[a][0] == MACHINE.bytes[b][0]]
    assert all(MACHINE._compatible((a, b)) == (MACHINE._merged(MACHINE.bytes[a] + MACHINE.bytes[b]) == [a, b]) for a, b in pairs)
    letters = list(bpe.byte_alphabet())
    left_out = 0
    for k in range(60):  # made vocabularies, some with several merges for a token or tokens that other merges take apart
        vocab, merges = {c: i for i, c in enumerate(letters)}, []
        pool = ["a", "b"]
        while len(merges) < 14:
            pair = (draw.choice(pool), draw.choice(pool))
            if pair not in merges and len(pair[0] + pair[1]) < 9:
                merges.append(pair)
                if pair[0] + pair[1] not in vocab:
                    vocab[pair[0] + pair[1]] = len(vocab)
                    pool.append(pair[0] + pair[1])
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps({"added_tokens": [], "model": {"vocab": vocab, "merges": [" ".join(m) for m in merges]}}))
        machine = bpe.Transducer(str(path))
        left_out += len(vocab) - len(machine.trees)
        for a, b in itertools.product([vocab[t] for t in pool], repeat=2):
            assert machine._compatible((a, b)) == (machine._merged(machine.bytes[a] + machine.bytes[b]) == [a, b])
    assert left_out > 0


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "a" * 20_000, "ab" * 9_000, "=" * 30_000, " " * 50_000, "é" * 9_001])
def test_special_tokens_and_long_pretokens(text):
    assert own(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_stream_holds_no_more_than_the_lookahead():
    draw = random.Random(2)
    for alphabet in ("ab", "abcde", "=-", "thein "):
        word = "".join(draw.choice(alphabet) for _ in range(6_000)).replace(" ", "x").encode()
        blocks = [word[i : i + 50] for i in range(0, len(word), 50)]
        sent = [0]

        def feed(blocks=blocks, sent=sent):
            for b in blocks:
                sent[0] += len(b)
                yield b

        out = 0
        for ids in MACHINE.stream(feed()):
            assert sent[0] - out <= 50 + MACHINE.lookahead + MACHINE.longest
            out += sum(len(MACHINE.bytes[i]) for i in np.frombuffer(ids, "<u4").tolist())
        assert out == len(word)


def test_decoder_waits_for_whole_characters():
    ids = own("naïve 😀 中")
    parts = [np.array([i], "<u4").tobytes() for i in ids]
    assert "".join(MACHINE.decode(parts)) == "naïve 😀 中"
    assert "".join(MACHINE.decode(parts[:-1])) == LIBRARY.decode(ids[:-1], skip_special_tokens=False)


def test_round_trip(spark):
    got = bpe.round_trip(documents(spark)).collect()
    want = []
    for i, t in ROWS:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    encoded = bpe.encode_documents(documents(spark))
    back = bpe.decode_documents(encoded).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in ROWS)
    assert bpe.round_trip(empty(spark)).count() == 0


# ---------- packing ----------


def check_packed(rows, capacity):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own_places in places.values():
        end = 0
        for at, length in sorted(own_places):
            assert at == end
            end += length
        assert end <= capacity
    return len(places)


def test_pack(spark):
    got = packing.pack(documents(spark), capacity=64, run=3).collect()
    want = []
    for i, t in ROWS:
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 64 or 64
        cuts = [(0, first), *((at, at + 64) for at in range(first, len(ids), 64))]
        want += [(str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(cuts)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert check_packed(got, 64) >= sum(r.length for r in got) / 64
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\n" * 1_100_000 + "b c", "x " * 1000])
def test_pieces_of_long_white_space(text):
    assert packing.encoded(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_places_of_runs_in_blocks(spark):
    rows = [(i, "same words here" if i % 3 else "others") for i in range(900)]
    got = packing.pack(documents(spark, rows), capacity=20, run=10, runs=4).collect()
    assert len(got) == 900 and check_packed(got, 20) == check_packed(packing.pack(documents(spark, rows), capacity=20).collect(), 20)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_best_two_fit_uses_every_piece(counts):
    patterns = packing.best_two_fit(counts, 50)
    used = collections.Counter()
    for times, own_sizes in patterns:
        assert times > 0 and sum(s * n for s, n in own_sizes.items()) <= 50
        for s, n in own_sizes.items():
            used[s] += times * n
    assert used == collections.Counter(counts)
    bins, gaps = sum(t for t, _ in patterns), []
    for s in sorted(used.elements(), reverse=True):  # first fit decreasing, piece by piece
        at = next((i for i, g in enumerate(gaps) if g >= s), len(gaps))
        gaps[at : at + 1] = [(gaps[at] if at < len(gaps) else 50) - s]
    assert bins <= len(gaps) * 1.2 + 1
    assert len(patterns) <= 100


def test_two_that_fit_tighter_replace_the_smallest():
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [(1, {6: 1, 2: 2}), (1, {3: 1})]


def test_hot_length_is_ranked_in_runs(spark):
    rows = [(i, "same words here") for i in range(700)]
    got = packing.pack(documents(spark, rows), capacity=20, run=50).collect()
    assert len(got) == 700 and check_packed(got, 20) == -(-700 // (20 // got[0].length))
