"""Containers whose boxes claim more than they hold give an error, within little memory."""

import struct
import tracemalloc

import pytest
from stationflow.llm import media

HUGE = 2**32 - 1


def flagged(kind, flags, *parts):
    return media._box(kind, struct.pack(">I", flags), *parts)


def patched(kind, old, new):
    """A small container with the content of its box `kind` (after version and flags) changed from old to new."""
    data = media.store(media.padded(b"text"))
    at = data.index(kind) + 8
    assert data[at : at + len(old)] == old
    return data[:at] + new + data[at + len(new) :]


def fragmented(n):
    run = flagged(b"trun", 0x1, struct.pack(">Ii", n, 0))
    moof = media._box(b"moof", media._full(b"mfhd", struct.pack(">I", 1)), media._box(b"traf", flagged(b"tfhd", 0x20000, struct.pack(">I", 1)), run))
    return media.store(media.padded(b"")) + moof


CLAIMS = {
    "stsz": patched(b"stsz", struct.pack(">II", media.SAMPLE, 1), struct.pack(">II", media.SAMPLE, HUGE)),
    "stts": patched(b"stts", struct.pack(">III", 1, 1, 1), struct.pack(">III", 1, HUGE, 1)),
    "stsc": patched(b"stsc", struct.pack(">IIII", 1, 1, 1, 1), struct.pack(">IIII", 1, 1, HUGE, 1)),
    "first chunk": patched(b"stsc", struct.pack(">IIII", 1, 1, 1, 1), struct.pack(">IIII", 1, HUGE, 1, 1)),
    "stco": patched(b"stco", struct.pack(">I", 1), struct.pack(">I", HUGE)),
    "trun": fragmented(HUGE),
    "trun in bytes": fragmented(5000),
    "tracks": media.store(media.padded(b""))[: -media.SAMPLE - 8],
}


@pytest.mark.parametrize("claim", sorted(CLAIMS))
def test_claims_are_bounded_by_the_container(claim):
    tracemalloc.start()
    try:
        with pytest.raises((ValueError, struct.error)):
            media.payload_of(CLAIMS[claim], media.probe(CLAIMS[claim]))
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
    finally:
        tracemalloc.stop()


def test_rows_tell_the_error(spark):
    df = spark.createDataFrame([(i, 1, bytearray(c)) for i, c in enumerate(CLAIMS.values())] + [(99, 1, bytearray(media.store(media.padded(b"good"))))], "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in media.media_columns(df).collect()}
    assert all(got[i].error and got[i].payload_bytes is None for i in range(len(CLAIMS))) and got[99].error is None and got[99].payload_bytes == media.SAMPLE


def test_one_pass_gives_what_two_give(docs):
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(media.text_media_columns(docs)) == rows(media.media_columns(media.store_media(docs)))
