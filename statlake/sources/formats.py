"""How text formats are written and read, so that a value comes back as it went out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..plans.sizing import quoted

# A null is nothing between the separators, an empty text a pair of quotes.  Spark's reader would take
# both for null, so it gives the quotes this private-use character, which is turned back into empty text.
_EMPTY = "\ue000"
_CSV = {"header": True, "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False}
CSV_WRITE = {**_CSV, "emptyValue": '""'}
# Values may hold line breaks, so a file is read as a whole: many files of bounded size, not one large.
CSV_READ = {**_CSV, "emptyValue": _EMPTY, "multiLine": True}


def empty_texts(df: DataFrame) -> DataFrame:
    """Empty texts of a CSV that was read with ``CSV_READ``."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(quoted(c)) == _EMPTY, F.lit("")).otherwise(F.col(quoted(c)))
                           for c in texts}) if texts else df
