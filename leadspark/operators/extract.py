"""Extraction of leads from articles by a model that the caller brings."""

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadspark.config import PROMPT_TEMPLATE
from leadspark.functions import checks, envelope, text
from leadspark.operators.validate import check

Model = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

REPLY_TEXT = "$.candidates[0].content.parts[0].text"


def with_prompt(articles: DataFrame, template: str = PROMPT_TEMPLATE) -> DataFrame:
    return articles.withColumn("prompt", text.render_prompt(F.col("clean_text"), template))


def with_reply(prompted: DataFrame, model: Model) -> DataFrame:
    """Run the model over batches of prompts; it adds the column `reply`.

    A reply is the JSON text {"candidates":[{"content":{"parts":[{"text": ...}]}}]}.
    Write the result to a table before using it twice, so that the model runs once.
    """
    schema = T.StructType(prompted.schema.fields + [T.StructField("reply", T.StringType())])
    return prompted.mapInPandas(model, schema)


def checked_reply(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """The text of each reply as one strict JSON record with its errors."""
    texts = replies.withColumn("text", F.get_json_object(reply, REPLY_TEXT))
    parsed = texts.withColumn("record", envelope.strict_json(F.col("text"))).withColumn(
        "rejected",
        F.when(F.col("text").isNull(), "no_text").when(F.col("record").isNull(), "not_json"),
    )
    return check(parsed, checks.ANALYSIS)


def _reply(clean_text: str, source_url: str) -> str:
    words = re.findall(r"[^\s.,]+", clean_text)
    low = clean_text.lower()
    analysis = {
        "companyName": words[0] if words else "Unknown",
        "industry": "Technology" if "tech" in low else "General",
        "region": "Global",
        "opportunityType": "Expansion" if "expansion" in low else "Merger",
        "summary": clean_text or "No text",
        "potentialNeed": ["Security"],
        "opportunityScore": len(words) % 10 + 1,
        "keyQuote": clean_text.split(".")[0].strip() or "No quote",
        "sourceURL": source_url,
    }
    body = json.dumps(analysis, ensure_ascii=False)
    reply = {"candidates": [{"content": {"parts": [{"text": body}]}}]}
    return json.dumps(reply, ensure_ascii=False)


def field_model(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A stand-in for tests that fills the fields by fixed rules from the whole text."""
    for batch in batches:
        pairs = zip(batch["clean_text"], batch["source_url"], strict=True)
        yield batch.assign(reply=[_reply(*pair) for pair in pairs])
