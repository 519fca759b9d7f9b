"""Texts cut into units that a byte-level tokenizer never joins tokens across.

A blank that follows a non-blank character always starts a new pre-token, so a text is the
concatenation of its units " word", and a unit has the same ids wherever it stands. Natural text
repeats its units, so ids are computed once per distinct unit and looked up for the rest. The
look-up table is bounded; it saves time and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_UNITS = 300_000
LONGEST_KEPT = 64

_NEW = b"?"  # told apart by identity: no unit is known yet
_BOUNDARY = re.compile(r"(?<=\S)(?= )")


class UnitTable:
    """Little-endian 32-bit ids of whole texts, by way of the ids of their units.

    ``encode`` maps a list of texts to the id bytes of each.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = TABLE_UNITS):
        self.encode = encode
        self.limit = limit
        # None for what starts with a blank: it continues a run of blanks, where no cut is sure.
        self.after_blank: dict[str, bytes | None] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The id bytes of each text; the units that are new in any of them are encoded at once.

        Arrow cuts the texts, numbers their distinct units and puts the ids of these in place, so
        Python handles each unit once a call, not once an occurrence.
        """
        known = self.after_blank
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at = cut.offsets.to_numpy()
        behind = np.ones(len(cut.values), bool)
        behind[at[:-1]] = False
        coded = cut.values.filter(pa.array(behind)).dictionary_encode()
        units = coded.dictionary.to_pylist()

        found: list[bytes | None] = [known.get(unit, _NEW) for unit in units]
        new = [i for i, ids in enumerate(found) if ids is _NEW]
        odd = {i for i in new if not units[i] or units[i][0].isspace()}
        fresh = [i for i in new if i not in odd]
        for i in odd:
            found[i] = None
        for i, ids in zip(fresh, self.encode([" " + units[i] for i in fresh]), strict=True):
            found[i] = ids
        kept = (i for i in new if len(units[i]) <= LONGEST_KEPT)
        known.update((units[i], found[i]) for i in islice(kept, max(0, self.limit - len(known))))

        joined = pa.array([ids or b"" for ids in found], pa.large_binary()).take(coded.indices)
        _, offsets, data = joined.buffers()
        ends = np.frombuffer(offsets, np.int64, len(joined) + 1, 8 * joined.offset)
        places = at - np.arange(len(at))
        ids_at = ends[places].tolist()
        view = memoryview(data or b"")
        heads = self.encode(cut.values.take(pa.array(at[:-1])).to_pylist())
        done = [head + view[a:b] for head, a, b in zip(heads, ids_at, ids_at[1:], strict=False)]

        unsure = np.array([ids is None for ids in found], bool)
        if unsure.any():
            before = np.concatenate([[0], np.cumsum(unsure[coded.indices.to_numpy()])])[places]
            for i in np.flatnonzero(np.diff(before)).tolist():
                done[i] = b"".join(self.encode(_BOUNDARY.split(texts[i])))
        return done
