"""Token counters by a tokenizer, in the place of the count by length."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def counter(encode: Callable[[str], Sequence[int]]) -> Callable[[Column | str], Column]:
    """A column function that counts what `encode` gives for a text, 1 at least; null for null. `encode` goes to the executors."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else max(1, len(encode(x)))).astype("Int64")

    return count


@dataclass(frozen=True)
class ServerTokenizer:
    """Asks a model server; it answers {"content": text} at /tokenize with {"tokens": [...]}."""

    url: str
    timeout: float = 60.0

    def __call__(self, text: str) -> list[int]:
        body = json.dumps({"content": text}).encode()
        request = urllib.request.Request(self.url.rstrip("/") + "/tokenize", body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.loads(reply.read()).get("tokens", [])
