"""Groupings within an array."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.parsing import let


def runs_of(values: Column, key: str | None = None) -> Column:
    """The sorted values cut where they change, or where their field `key` does: an array per distinct one; a narrow step."""

    def same(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if key is None else a[key].eqNullSafe(b[key])

    def cut(found: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: (i == 1) | ~same(found[i - 1], found[F.greatest(i - 2, F.lit(0))]))

        def runs(starts: Column) -> Column:
            def run(start: Column, i: Column) -> Column:
                after = F.coalesce(F.get(starts, i + 1), F.size(found) + 1)
                return F.slice(found, start, after - start)

            return F.transform(starts, run)

        return F.when(F.size(found) > 0, let(begins, runs)).when(found.isNotNull(), F.slice(F.array(found), 1, 0))

    return let(F.sort_array(values), cut)
