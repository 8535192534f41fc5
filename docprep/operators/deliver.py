"""Names, prices, prompts and parameters of what is delivered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_PRICE, PRICES, RETRIEVAL_PARAMS


def output_name(stem: Column, index: Column, version: int = 1) -> Column:
    """NAM1"""
    base = F.regexp_replace(F.regexp_replace(stem, r"\A\d+[_-]", ""), r"[^a-zA-Z0-9]+", "_")
    base = F.substring(F.lower(F.regexp_replace(base, r"\A_+|_+\z", "")), 1, 30)
    return F.format_string(f"%02d_%s_sem_v{version}.md", index, base)


def price(model: Column, i: int) -> Column:
    return reduce(lambda c, kv: c.when(model == kv[0], kv[1][i]), PRICES.items(), F).otherwise(DEFAULT_PRICE[i])


def cost(model: Column, tokens_in: Column, tokens_out: Column) -> Column:
    """CST1: in currency units."""
    return (tokens_in * price(model, 0) + tokens_out * price(model, 1)) / 1_000_000


def estimate(docs: DataFrame, prompt_chars: int, model: str, text: str = "text", stripped: Column | None = None) -> DataFrame:
    """CST2: one row for the whole corpus; sums only."""
    price_in, price_out = PRICES.get(model, DEFAULT_PRICE)
    n, chars = F.count("*"), F.sum(F.length(F.col(text)).cast("long"))
    tokens = F.floor(chars / 4).cast("long")
    kept = chars if stripped is None else F.sum(F.length(stripped).cast("long"))
    return docs.agg(n.alias("n_docs"), chars.alias("n_chars"), tokens.alias("tokens"), F.floor(kept / 4).cast("long").alias("tokens_stripped"), F.round(((prompt_chars // 4 * n + tokens) * price_in + tokens * 1.1 * price_out) / 1_000_000, 6).alias("estimated_cost"))


def max_tokens(c: Column) -> Column:
    """TOK1"""
    return F.greatest(F.lit(4000), F.least(F.lit(32000), F.floor(F.length(c) / 2))).cast("long")


def retrieval(kind: Column) -> dict[str, Column]:
    """RTV1: unknown kinds are as ``mixto``."""
    names = ("top_k", "tokens_total", "tokens_chunk", "threshold", "context_messages")
    return {n: reduce(lambda c, kv, i=i: c.when(kind == kv[0], kv[1][i]), RETRIEVAL_PARAMS.items(), F).otherwise(RETRIEVAL_PARAMS["mixto"][i]) for i, n in enumerate(names)}


def build_prompt(text: Column, project: Column, date: Column, part: Column) -> Column:
    """PRM1, from the columns of a diagnosis and decision."""
    rule = "─" * 49
    rows = [("Proyecto", project), ("Fecha", date), ("Estrategia", F.col("strategy")), *((n, F.col(n).cast("string")) for n in ("max_chars", "overlap", "min_chunk_size")), ("Tipo proyecto", F.col("project_type")), ("Longitud entidades", F.col("entity_len"))]
    head = [x for k, v in rows for x in (F.lit(f"- {k}: "), v, F.lit("\n"))]
    return F.concat(F.lit("PARÁMETROS CALCULADOS:\n"), *head, F.when(part != "", F.concat(F.lit("- Parte: "), part, F.lit("\n"))).otherwise(""), F.lit(f"\nTEXTO BRUTO:\n{rule}\n"), text, F.lit(f"\n{rule}\n"))


def refine_prompt(title: Column, i: Column, n: Column, text: Column) -> Column:
    """PRM2"""
    part = F.when(n > 1, F.format_string(" (chunk %d/%d)", i, n)).otherwise("")
    return F.concat(F.lit("Título: "), title, part, F.lit("\n\n"), text)
