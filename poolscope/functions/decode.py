"""Decoding of compressed messages: the one Python function of the library.

Spark has no built-in inflate, so batches go through Arrow. Each call handles one text per
row; long texts are decoded whole.
"""

from __future__ import annotations

import base64
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: attributes that carry a compressed message.
MESSAGE_ATTRIBUTE = r"^Chirp_WMCore_[A-Za-z0-9]+_Exception_Message$"


def _decoders():
    # Defined inside a function so that the code itself travels to the Python workers; they
    # need no copy of this package.
    def inflate(text):
        if text is None:
            return None
        try:
            return zlib.decompress(base64.b64decode(text)).decode("utf-8", "replace")
        except (TypeError, ValueError, zlib.error):
            return text

    def one(texts: pd.Series) -> pd.Series:
        return texts.map(inflate)

    def many(lists: pd.Series) -> pd.Series:
        return lists.map(lambda texts: None if texts is None else [inflate(t) for t in texts])

    return (
        F.pandas_udf(one, T.StringType()),
        F.pandas_udf(many, T.ArrayType(T.StringType())),
    )


# decode_message: base64 -> zlib -> text; texts that are not of this form come back as they are.
# decode_messages: the same for every text of a list.
decode_message, decode_messages = _decoders()
