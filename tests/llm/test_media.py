import hashlib
import tarfile
import zlib

import pytest

from decklight.llm import media
from decklight.llm.media import by_span, from_png, sample_features, store_payloads, to_png, with_metadata, with_samples

SCHEMA = "doc_id long, text string, digest string, shard int"


def plain_png(data):
    """The samples of an 8-bit grey PNG by the standard, with all five line filters."""
    assert data[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10])
    at, packed = 8, b""
    while at < len(data):
        n = int.from_bytes(data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        assert int.from_bytes(data[at + 8 + n : at + 12 + n]) == zlib.crc32(kind + body)
        if kind == b"IHDR":
            width, height = int.from_bytes(body[:4]), int.from_bytes(body[4:8])
            assert body[8:] == bytes([8, 0, 0, 0, 0])
        packed += body if kind == b"IDAT" else b""
        at += 12 + n
    raw, above, out = zlib.decompress(packed), bytes(width), b""
    for y in range(height):
        kind, line = raw[y * (width + 1)], bytearray(raw[y * (width + 1) + 1 : (y + 1) * (width + 1)])
        for x in range(width):
            a, b, c = line[x - 1] if x else 0, above[x], above[x - 1] if x else 0
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            line[x] = (line[x] + (0, a, b, (a + b) // 2, near)[kind]) % 256
        above = bytes(line)
        out += above
    return out


def plain_feature(payload):
    n, mean = len(payload), sum(payload) / len(payload)
    deviation = (sum(b * b for b in payload) / n - mean**2) ** 0.5
    edges = [i * n // 64 for i in range(65)]
    bits = "".join(str(int(sum(payload[a:b]) / (b - a) > mean)) for a, b in zip(edges, edges[1:]))
    return f"mean={mean:.3f};std={deviation:.3f};ahash={int(bits, 2):016x}"


def test_another_decoder_and_plain_features():
    for payload in (bytes(range(192)) * 3, b"text of it" * 96, b" " * 192):
        assert plain_png(to_png(payload)) == payload
        assert sample_features(payload) == plain_feature(payload)


def test_round_trip_and_damage():
    payload = bytes(range(192)) * 3
    assert from_png(to_png(payload)) == payload
    bad = bytearray(to_png(payload))
    bad[50] ^= 1
    with pytest.raises(ValueError):
        from_png(bytes(bad))


@pytest.mark.parametrize("shard_bytes", [1 << 28, 1000])
def test_rows_point_into_tar_shards(spark, tmp_path, monkeypatch, shard_bytes):
    monkeypatch.setattr(media, "SHARD_BYTES", shard_bytes)
    texts = [None, "", " ", "a", "é" * 500, "a", "x" * 192, "long " * 50_000]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "a", None, None), (3, "a", None, None), (3, "a", None, None)], SCHEMA)
    folder = f"file://{tmp_path}/m"
    monkeypatch.setattr(media, "SPAN_BYTES", 2000)
    found = with_samples(with_metadata(by_span(store_payloads(docs, folder)), folder), folder).collect()
    got = {r.doc_id: r for r in found}
    assert len(got) == len(texts) + 1 and len(found) == len(texts) + 3 and [r for r in found if r.doc_id == 3] == [got[3]] * 3
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.media_bytes == len(to_png(payload))
        assert r.media_sha256 == hashlib.sha256(to_png(payload)).hexdigest() and r.width * r.height == len(payload)
        assert r.feature == plain_feature(payload)
    assert got[3][1:] == got[5][1:] == got[None][1:]
    for path in (tmp_path / "m/shards").iterdir():
        with tarfile.open(path) as tar:
            names = [m.name for m in tar]
            assert len(names) == len(set(names))


def test_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/e"
    assert with_samples(with_metadata(by_span(store_payloads(spark.createDataFrame([], SCHEMA), folder)), folder), folder).count() == 0
