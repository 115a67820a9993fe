"""Words of a text, as every operator here counts them: runs of ``[^\\x20\\x09-\\x0D]``.

``bytes.split`` breaks at exactly these six characters, and at none of Unicode's other white space.
"""

import pyarrow as pa

from tidemark.llm import tokens


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty.

    Spark hands workers on from job to job: one that reads texts as bytes is done with encoding them.
    """
    tokens.forget()
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def words(text: bytes) -> list[bytes]:
    return text.split()
