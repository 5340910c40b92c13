"""Model requests and responses as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions import lexicon as lx
from tagloom.functions.bind import let
from tagloom.functions.prompts import BODY_PROMPT, TITLE_PROMPT
from tagloom.functions.rules import normalise_label

# --- fixed values: default models -------------------------------------------
FIRST_MODEL = "openai/gpt-4.1"
SECOND_MODEL = "openai/gpt-4o"
MAX_ATTEMPTS = 3

Prompt = Callable[[Column], Column]


def title_prompt(title: Column, template: str = TITLE_PROMPT) -> Column:
    return F.concat(F.lit(template), title)


def body_prompt(text: Column, template: str = BODY_PROMPT) -> Column:
    return F.concat(F.lit(template), text)


def request_body(text: Column, model: str = FIRST_MODEL, prompt: Prompt = title_prompt) -> Column:
    """JSON body of a chat request: the prompt as system message, the text as user message."""
    message = lambda role, content: F.struct(
        F.lit(role).alias("role"), content.cast("string").alias("content")
    )
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message("system", prompt(text)), message("user", text)).alias("messages"),
        )
    )


def response_label(response: Column) -> Column:
    """Domain label of a raw response.

    A response without ``choices[0].message.content`` counts as a general
    remark.  A JSON null there is an empty answer, hence a simple reaction.
    """

    def label(content: Column) -> Column:
        text = F.when(~F.is_variant_null(content), F.try_variant_get(content, "$", "string"))
        return F.when(content.isNull(), F.lit(lx.GENERAL)).otherwise(normalise_label(text))

    parsed = F.try_parse_json(response)
    return let(F.try_variant_get(parsed, "$.choices[0].message.content", "variant"), label)
