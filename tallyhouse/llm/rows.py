"""Walking sorted Arrow batches group by group, and names beside those of a frame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches, n_keys: int, at_least: int = 1) -> Iterator[pa.Table]:
    """Rows of whole groups, of batches that are sorted by their first ``n_keys`` columns (whole numbers).

    A group is what agrees in these columns. With ``at_least``, groups are handed out together until they
    have that many rows.
    """
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        keys = np.stack([table.column(i).to_numpy() for i in range(n_keys)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        begin = 0
        for cut in cuts:
            if cut - begin >= at_least:
                yield table.slice(begin, cut - begin)
                begin = cut
        held = table.slice(begin)
    if held is not None and held.num_rows:
        yield held


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores added until no column has it; Spark does not tell cases apart."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name += "_"
    return name
