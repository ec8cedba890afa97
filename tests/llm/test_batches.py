"""How questions of batches travel."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from poolscope.llm import batches


@pytest.mark.parametrize("kind", [np.int64, np.uint32, np.uint8])
def test_packed_numbers_come_back_and_small_ones_take_little_room(kind):
    values = np.random.default_rng(1).integers(0, 100, 5000).astype(kind)
    packed = batches._packed(values)
    for part in (values, values[:1], values[:0]):
        assert (batches._unpacked(pa.scalar(batches._packed(part), pa.binary()), kind) == part).all()
    assert len(zlib.compress(packed, 1)) < 1.2 * len(values)


def test_packed_keys_are_steps():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    # the part of one of a hundred ranges
    part = keys // np.uint64(100) + np.uint64(2**63)
    for some in (part, keys, keys[:0]):
        assert (batches._unpacked_keys(pa.scalar(batches._packed_keys(some), pa.binary())) == some).all()
    assert len(zlib.compress(batches._packed_keys(part), 1)) < 0.9 * len(zlib.compress(part.tobytes(), 1))
