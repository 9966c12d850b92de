"""Hand-made bronze rows."""

import datetime as dt
import json

from questmart.schemas import SCHEMAS, Bronze
from questmart.sources.rates import exchange_rate


def at(text):
    return dt.datetime.fromisoformat(text)


def _row(table, values):
    names = [field.split()[0] for field in SCHEMAS[table].split(", ")]
    unknown = set(values) - set(names)
    assert not unknown, unknown
    return tuple(values.get(name) for name in names)


def frame(spark, table, rows):
    return spark.createDataFrame([_row(table, r) for r in rows], SCHEMAS[table])


def event(number, kind, subtype, when, account, session=None, **payload):
    return {
        "event_id": number, "event_type": kind, "event_subtype": subtype, "event_date": at(when), "account_id": account,
        "session_id": session, "event_metadata": json.dumps(payload, separators=(",", ":")),
    }


def sale(number, when, account, session, offer="off_a", cost=10, currency="USD", rate=1.0, category=("currency",)):
    payload = {"offer_id": offer, "cost_amount": cost, "currency_name": currency, "exchange_rate": rate}
    if category is not None:
        payload["reward_category"] = list(category)
    return event(number, "business", "business", when, account, session, **payload)


def session(number, account, start, seconds=60, **more):
    begin = at(start)
    return {
        "session_id": number, "account_id": account, "session_start": begin,
        "session_end": begin + dt.timedelta(seconds=seconds), "duration_seconds": seconds, "platform": "iOS",
        "device_model": "d", "end_reason": "player_exit", "app_version": "1.0.0.a", **more,
    }


def bronze(spark, **rows):
    tables = {name: frame(spark, name, rows.get(name, [])) for name in SCHEMAS if name != "exchange_rate"}
    return Bronze(**tables, exchange_rate=exchange_rate(spark))
