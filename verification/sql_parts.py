"""Pieces shared by the checking SQL."""

from __future__ import annotations


def div(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def exact_ratio(n: str, d: str, digits: int) -> str:
    return f"round(CAST({div(n, d)} AS DECIMAL(18,6)), {digits})"


def ratio(n: str, d: str, digits: int) -> str:
    return f"CAST({exact_ratio(n, d, digits)} AS DOUBLE)"


def percent(n: str, d: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({div(n, d)} AS DECIMAL(18,8)) * 100, {digits}) AS DOUBLE)"


def text(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {alias or column.split('.')[-1]}"


# Purchases in USD by both rates.
SPENDING = f"""
spending AS (
    SELECT b.*, {exact_ratio('b.cost', 'COALESCE(x.usd_exchange_rate, 1)', 2)} AS usd,
           {exact_ratio('b.cost', 'b.event_rate', 2)} AS usd_event,
           CAST({div('b.cost', 'COALESCE(x.usd_exchange_rate, 1)')} AS DECIMAL(18,6)) AS usd_exact
    FROM (SELECT account_id, session_id, CAST(event_date AS DATE) AS day, event_date,
                 event_metadata ->> '$.offer_id' AS offer_id,
                 CAST(json_extract(event_metadata, '$.reward_category') AS VARCHAR) AS reward_category,
                 event_metadata ->> '$.currency_name' AS currency,
                 CAST(event_metadata ->> '$.cost_amount' AS DECIMAL(18,3)) AS cost,
                 CAST(event_metadata ->> '$.exchange_rate' AS DECIMAL(18,3)) AS event_rate
          FROM events_role WHERE event_type = 'business') b
    LEFT JOIN exchange_rate x ON x.currency = b.currency)"""
