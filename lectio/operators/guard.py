"""Python steps of which one bad row does not cost the others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.sources.shared import stored

#: A row that failed: which step, which row, why.
DEAD = "label string, id string, error string"


def tried(run: Callable[[pd.DataFrame], pd.DataFrame], pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, Exception | None]]:
    """(result, None) of parts that went well, (row, error) of single rows that did not: a part that fails is halved."""
    try:
        yield run(pdf), None
    except Exception as error:  # whatever it was, it is the row's
        if len(pdf) <= 1:
            yield pdf, error
        else:
            half = len(pdf) // 2
            yield from tried(run, pdf.iloc[:half].reset_index(drop=True))
            yield from tried(run, pdf.iloc[half:].reset_index(drop=True))


def guarded(df: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """mapInPandas with ``run`` (a frame in, a frame of ``schema`` out, each row by itself) -> (good rows, dead letters: DEAD).

    Both come from one table that is written once, so ``run`` is not called again for either. A batch with k bad rows costs some
    k log n further calls. No rows: run is not called.
    """
    whole = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField("_dead", T._parse_datatype_string(f"struct<{DEAD.replace(' string', ':string')}>"))])

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for found, error in tried(run, pdf) if len(pdf) else ():
                if error is None:
                    yield found.assign(_dead=None)
                else:
                    row = {f.name: [None] for f in schema.fields} | {"_dead": [{"label": label, "id": str(found[key].iloc[0]), "error": f"{type(error).__name__}: {error}"[:1000]}]}
                    yield pd.DataFrame(row, dtype=object)

    rows = stored(df.mapInPandas(each, whole), label)
    return rows.filter("_dead is null").drop("_dead"), rows.filter("_dead is not null").select("_dead.*")
