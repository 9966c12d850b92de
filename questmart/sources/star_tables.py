"""Bronze roles derived from a retail star schema (customer, orders, lineitem, part, supplier).

Each role is one projection over one table, so it adds no shuffle to the mart that reads it. The texts keep
to the expressions that Spark SQL and ANSI engines share; ``{...}`` marks the few that need a dialect form.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from questmart.functions.catalog import SERIES_OFFERS
from questmart.schemas import SCHEMAS
from questmart.session import new_stage_path, open_folders
from questmart.sources.rates import USD_RATES, exchange_rate


class SparkDialect:
    @staticmethod
    def day(column: str) -> str:
        """The column's day folded into the 91 days from 2024-12-31."""
        return f"date_add(DATE '2024-12-31', pmod(datediff({column}, DATE '1995-01-01'), 91))"

    @staticmethod
    def plus_days(date: str, days: str) -> str:
        return f"date_add({date}, CAST({days} AS INT))"

    @staticmethod
    def at(date: str, seconds: str) -> str:
        return f"(CAST({date} AS TIMESTAMP) + make_dt_interval(0, 0, 0, {seconds}))"

    @staticmethod
    def text(expression: str) -> str:
        return f"CAST({expression} AS STRING)"

    array_of_ids = "to_json(sequence(s_suppkey * 20, s_suppkey * 20 + 3))"
    two_campaigns = "explode(CASE WHEN p_size > 40 THEN array(0, 1) ELSE array(0) END)"


class AnsiDialect:
    @staticmethod
    def day(column: str) -> str:
        return f"(DATE '2024-12-31' + CAST(date_diff('day', DATE '1995-01-01', CAST({column} AS DATE)) % 91 AS INT))"

    @staticmethod
    def plus_days(date: str, days: str) -> str:
        return f"({date} + CAST({days} AS INT))"

    @staticmethod
    def at(date: str, seconds: str) -> str:
        return f"(CAST({date} AS TIMESTAMP) + ({seconds}) * INTERVAL 1 SECOND)"

    @staticmethod
    def text(expression: str) -> str:
        return f"CAST({expression} AS VARCHAR)"

    array_of_ids = "CAST(to_json(range(s_suppkey * 20, s_suppkey * 20 + 4)) AS VARCHAR)"
    two_campaigns = "unnest(CASE WHEN p_size > 40 THEN [0, 1] ELSE [0] END)"


def _pick(selector: str, values: list[str | None]) -> str:
    """CASE over a zero-based integer selector."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"(CASE {selector} {arms} END)"


def _item(slot: str, bases: list[str]) -> str:
    rarity = _pick("CAST(l_partkey % 6 AS INT)", ["c", "u", "r", "e", "l", "x"])
    base = _pick(f"CAST(l_suppkey % {len(bases)} AS INT)", bases)
    return f"(CASE WHEN l_partkey % 11 = 0 THEN '' ELSE concat({rarity}, '_{slot}_', {base}) END)"


def role_sql(dialect: type[SparkDialect] | type[AnsiDialect]) -> dict[str, str]:
    """One SELECT per bronze role (the rate table excepted)."""
    d = dialect
    txt = d.text
    order_account = f"{txt('CAST(floor(l_orderkey / 10) AS BIGINT)')}"
    level = (
        f"(CASE WHEN l_suppkey % 20 = 0 THEN concat('TUTORIAL_00', {txt('l_partkey % 3 + 1')}) "
        f"ELSE concat('LEVEL_', lpad({txt('l_partkey % 100 + 1')}, 3, '0')) END)"
    )
    equipment = (
        "concat('\"equipped_hero\":\"h_', "
        + _pick("CAST(l_partkey % 3 AS INT)", ["rogue", "warrior", "battlemage"])
        + ", '\",\"equipped_skin\":\"', "
        + _pick("CAST(l_suppkey % 4 AS INT)", ["s_r_assassin", "s_c_knight_red", "s_default", "s_e_mage"])
        + ", '\",\"equipped_weapon\":\"', "
        + _item("wp", ["dagger", "mace", "staff"])
        + ", '\",\"equipped_held_item\":\"', "
        + _item("hi", ["buckler", "potion", "tower_shield"])
        + ", '\",\"equipped_armor\":\"', "
        + _item("arm", ["cloak", "plate"])
        + ", '\"')"
    )
    score = txt("800 + (l_partkey % 100) * 50 + (l_partkey * 31 + l_suppkey * 17) % 700")
    stars = txt("(l_partkey + l_suppkey) % 4")
    cents = "(CAST(floor(l_extendedprice) AS BIGINT) % 20000)"
    amount = f"concat({txt(f'CAST(floor({cents} / 100) AS BIGINT)')}, '.', lpad({txt(f'{cents} % 100')}, 2, '0'))"
    offer = _pick("CAST(l_partkey % 14 AS INT)", [*SERIES_OFFERS, "off_starter_pack", "off_season_pass"])
    category = _pick(
        "CAST(l_suppkey % 3 AS INT)",
        ['"reward_category":["currency","currency"],', '"reward_category":["hero"],', ""],
    )
    currency = _pick("CAST(l_suppkey % 7 AS INT)", ["USD", "EUR", "TRY", "GBP", "BRL", "ZZZ", "JPY"])
    event_rate = _pick("CAST(l_suppkey % 7 AS INT)", ["1.0", "0.93", "32.0", "0.78", "0", "1.5", "151.0"])
    reason = (
        "(CASE CAST(l_partkey % 5 AS INT) WHEN 1 THEN 'shop_chest' WHEN 2 THEN 'daily_reward' WHEN 3 THEN 'upgrade' ELSE level_id END)"
    )
    item = _pick("CAST(l_suppkey % 5 AS INT)", ["currency_gold", "currency_gold", "currency_diamond", "chest_rare", "currency_gold"])
    item_category = "(CASE WHEN l_suppkey % 5 = 3 THEN 'chest' ELSE 'currency' END)"
    subtype = (
        "(CASE l_linenumber WHEN 1 THEN 'level_start' "
        "WHEN 2 THEN (CASE l_returnflag WHEN 'A' THEN 'level_success' WHEN 'N' THEN 'level_fail' ELSE 'level_abandon' END) "
        "WHEN 3 THEN 'business' WHEN 4 THEN 'source_item' WHEN 5 THEN 'sink_item' "
        "WHEN 6 THEN (CASE l_returnflag WHEN 'A' THEN 'ad_shown' WHEN 'N' THEN 'reward_ad_shown' ELSE 'ad_skipped' END) "
        "ELSE 'app_crash' END)"
    )
    outcome = (
        f"(CASE WHEN l_linenumber = 2 THEN concat(CASE WHEN l_returnflag = 'A' THEN concat(',\"stars_gained\":', {stars}) ELSE '' END, "
        f"',\"total_score\":', {score}) ELSE '' END)"
    )
    payload = (
        "(CASE "
        f"WHEN l_linenumber <= 2 THEN concat('{{\"level_id\":\"', level_id, '\",', equipment, {outcome}, '}}') "
        f"WHEN l_linenumber = 3 THEN concat('{{\"offer_id\":\"', {offer}, '\",', {category}, "
        f"'\"reward_id\":[\"r1\"],\"cost_type\":\"money\",\"cost_amount\":', {amount}, "
        f"',\"currency_name\":\"', {currency}, '\",\"exchange_rate\":', {event_rate}, '}}') "
        f"WHEN l_linenumber <= 5 THEN concat('{{\"item_category\":\"', {item_category}, '\",\"item_id\":\"', {item}, "
        f"'\",\"item_amount\":', {txt('CAST(floor(l_quantity) AS BIGINT) * 5')}, ',\"reason\":\"', {reason}, '\"}}') "
        f"WHEN l_linenumber = 6 THEN concat('{{\"ad_id\":\"', {txt('l_partkey')}, '\"}}') "
        "ELSE '{\"error_id\":\"e1\"}' END)"
    )
    event_time = d.at(d.day("l_shipdate"), "CAST((l_orderkey * 7919 + l_linenumber * 60 + l_suppkey % 60) % 86400 AS INT)")
    ad_model = "CAST(p_size % 5 AS INT)"
    k = "CAST(replace(replace(props, '{\"k\": ', ''), '}', '') AS INT)"
    stream_offer = _pick(f"({k} % 14)", [*SERIES_OFFERS, "off_starter_pack", "off_season_pass"])
    stream_device = _pick(f"({k} % 3)", ["iPhone 13", "Pixel 8", "IOS tablet"])
    return {
        "stream": f"""
            SELECT event_id,
                   (CASE event_type WHEN 'signup' THEN 'authentication' WHEN 'error' THEN 'authentication' WHEN 'click' THEN 'error'
                         WHEN 'purchase' THEN 'business' ELSE 'progression' END) AS event_type,
                   (CASE event_type WHEN 'signup' THEN 'user_login' WHEN 'error' THEN 'user_logout' WHEN 'click' THEN
                         (CASE WHEN {k} % 2 = 0 THEN 'app_crash' ELSE 'network_error' END)
                         WHEN 'purchase' THEN 'business' ELSE 'level_start' END) AS event_subtype,
                   CAST(ts AS TIMESTAMP) AS event_date, {txt('user_id')} AS account_id, CAST(NULL AS BIGINT) AS session_id,
                   (CASE event_type WHEN 'signup' THEN concat('{{"device_model":"', {stream_device}, '","os_version":"os', {txt(f'{k} % 5')},
                         '","app_version":"1.0.', {txt(f'{k} % 3')}, '"}}')
                         WHEN 'purchase' THEN concat('{{"offer_id":"', {stream_offer}, '"}}') ELSE '{{}}' END) AS event_metadata
            FROM events""",
        "accounts": f"""
            SELECT {txt('c_custkey')} AS account_id, c_name AS username,
                   concat(lower(c_name), '@example.org') AS email, c_custkey % 3 = 0 AS email_is_anonymized,
                   {d.at(d.plus_days("DATE '2024-12-31'", "c_custkey * 37 % 60"), "CAST(c_custkey * 7919 % 86400 AS INT)")} AS signup_date,
                   concat('N', {txt('c_nationkey')}) AS country,
                   {_pick("CAST(c_custkey % 7 AS INT)", ["ad_fb", "ad_search_engine", "friend_referral", "organic_search", "ad_ig", "podcast", None])} AS referral_source,
                   c_mktsegment AS creation_method, 'active' AS status,
                   (CASE WHEN c_custkey % 7 IN (0, 1, 4) THEN concat('{{"campaign_name":"', {txt('c_nationkey')}, '","ad_name":"ad ', {txt('CAST(floor(c_custkey / 5) AS BIGINT)')},
                         '"', CASE WHEN c_custkey % 7 = 1 THEN concat(',"search_ad_keyword":"', lower(c_mktsegment), '"') ELSE '' END, '}}')
                         WHEN c_custkey % 7 = 2 THEN concat('{{"referral_account_id":"', {txt('CAST(floor(c_custkey / 3) AS BIGINT)')}, '","referral_code":"ref', {txt('c_custkey')}, '"}}')
                         WHEN c_custkey % 7 = 3 THEN concat('{{"search_query":"', lower(c_mktsegment), '"}}') END) AS acquisition_metadata,
                   concat('dev', {txt('c_custkey % 9')}) AS device_model, concat('os', {txt('c_custkey % 4')}) AS os_version
            FROM customer""",
        "sessions": f"""
            SELECT o_orderkey AS session_id, {txt('o_custkey')} AS account_id,
                   {d.at(d.day('o_orderdate'), 'CAST(o_orderkey * 7919 % 86400 AS INT)')} AS session_start,
                   {d.at(d.day('o_orderdate'), 'CAST(o_orderkey * 7919 % 86400 + CAST(floor(o_totalprice) AS BIGINT) % 5400 AS INT)')} AS session_end,
                   CAST(floor(o_totalprice) AS BIGINT) % 5400 AS duration_seconds,
                   concat('N', {txt('o_custkey % 25')}) AS region,
                   (CASE o_orderstatus WHEN 'F' THEN 'iOS' ELSE 'Android' END) AS platform,
                   o_orderpriority AS device_model, concat('os', {txt('o_orderkey % 4')}) AS os_version,
                   {_pick("CAST(o_orderkey % 3 AS INT)", ["1.0.0.a", "1.0.0.b", "1.0.0"])} AS app_version,
                   {_pick("CAST(o_orderkey % 11 AS INT)", ["app_crash", "network_error", "app_crash", "player_exit", "player_exit", "player_exit", "player_exit", "player_exit", "player_exit", "player_exit", None])} AS end_reason
            FROM orders""",
        "events": f"""
            SELECT l_orderkey * 10 + l_linenumber AS event_id,
                   (CASE WHEN l_linenumber IN (1, 2) THEN 'progression' WHEN l_linenumber = 3 THEN 'business'
                         WHEN l_linenumber IN (4, 5) THEN 'resource' WHEN l_linenumber = 6 THEN 'ad' ELSE 'error' END) AS event_type,
                   {subtype} AS event_subtype, {event_time} AS event_date, {order_account} AS account_id,
                   (CASE WHEN l_linestatus = 'O' AND l_suppkey % 13 = 0 THEN NULL ELSE l_orderkey END) AS session_id,
                   {payload} AS event_metadata
            FROM (SELECT *, {level} AS level_id, CASE WHEN l_linenumber <= 2 THEN {equipment} END AS equipment FROM lineitem) rows_""",
        "hosted_ads": f"""
            SELECT {txt('p_partkey')} AS ad_id, p_brand AS ad_network, p_name AS advertised_product,
                   {_pick(ad_model, ["CPM", "CPC", "CPI", "CPA", "FLAT"])} AS pricing_model,
                   CAST(floor(p_retailprice) AS BIGINT) % 40 / 8.0E0 AS value_per_action,
                   {d.plus_days("DATE '2024-12-31'", "p_partkey % 60")} AS start_date,
                   {d.plus_days("DATE '2025-02-01'", "p_partkey % 60")} AS end_date,
                   p_partkey % 4 <> 0 AS is_active, p_size AS ad_length, p_partkey % 2 = 0 AS rewarded
            FROM part""",
        "hosted_ad_interactions": f"""
            SELECT l_orderkey * 10 + l_linenumber AS interaction_id, {order_account} AS account_id,
                   {txt('l_partkey')} AS ad_id, {event_time} AS interaction_time,
                   (CASE l_returnflag WHEN 'A' THEN 'click' WHEN 'N' THEN 'install' ELSE 'action' END) AS interaction_type,
                   CAST(floor(l_extendedprice) AS BIGINT) % 64 / 64.0E0 AS revenue,
                   (CASE l_linestatus WHEN 'F' THEN 'iOS' ELSE 'Android' END) AS platform,
                   concat('N', {txt('l_suppkey % 25')}) AS region, concat('dev', {txt('l_suppkey % 9')}) AS device_model
            FROM lineitem""",
        "ads": f"""
            SELECT CAST(p_partkey AS INT) AS ad_id, concat('ad ', {txt('p_partkey')}) AS ad_name, p_brand AS studio,
                   CAST({d.plus_days("DATE '2024-12-31'", "p_partkey % 60")} AS TIMESTAMP) AS launch_date, p_size > 5 AS is_active,
                   p_type AS ad_type, p_brand AS acquisition_source,
                   {_pick(ad_model, ["CPM", "CPC", "CPI", "CPA", "FLAT"])} AS pricing_model,
                   CAST(p_partkey * 7 % 5000 AS INT) AS impression_count, CAST(p_partkey * 3 % 400 AS INT) AS click_count,
                   CAST(p_partkey % 90 AS INT) AS install_count, CAST(p_partkey % 30 AS INT) AS action_count,
                   CAST(p_size AS DOUBLE) / 8 AS cost_per_interaction
            FROM part""",
        "campaigns": f"""
            SELECT CAST(s_suppkey AS INT) AS campaign_id, s_name AS campaign_name,
                   CAST(DATE '2024-12-31' AS TIMESTAMP) AS start_date, CAST(DATE '2025-03-31' AS TIMESTAMP) AS end_date,
                   {_pick("CAST(s_suppkey % 5 AS INT)", ["CPM", "CPC", "CPI", "CPA", "BRAND"])} AS campaign_type,
                   s_acctbal AS budget, 'active' AS status,
                   concat('src', {txt('s_nationkey % 4')}) AS acquisition_source, {d.array_of_ids} AS associated_ads
            FROM supplier""",
        "ad_campaign_map": f"""
            SELECT CAST(ad_id * 10 + slot AS INT) AS mapping_id, CAST(ad_id AS INT) AS ad_id,
                   CAST(floor(ad_id / 20) + slot AS INT) AS campaign_id,
                   CAST(DATE '2024-12-31' AS TIMESTAMP) AS association_start, CAST(DATE '2025-03-31' AS TIMESTAMP) AS association_end
            FROM (SELECT p_partkey AS ad_id, {d.two_campaigns} AS slot FROM part) linked""",
    }


def ansi_ctes() -> dict[str, str]:
    """The same roles as common table expressions of an ANSI engine."""
    rates = ", ".join(f"('{currency}', {rate!r}::DOUBLE)" for currency, rate in USD_RATES)
    return {
        **role_sql(AnsiDialect),
        "exchange_rate": f"SELECT * FROM (VALUES {rates}) AS rates(currency, usd_exchange_rate)",
    }


STAR_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "events", "nation", "region"]


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ``stream`` is a second events table with logins and logouts but no sessions yet.
ROLE_SCHEMAS = {**SCHEMAS, "stream": SCHEMAS["events"]}

# Stored layout of the large roles: marts filter events by type, so types become directories.
PARTITIONED_BY = {"events": ["event_type"]}

_stored: dict[tuple[str, str, str], str] = {}
_lock = threading.Lock()


class StarBronze:
    """Bronze roles, each written to the shared folder when first asked for and read back as a stored table.

    Marts thus read what they would read in production: columnar tables with the payload as one text column.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir

    def __getattr__(self, role: str) -> DataFrame:
        if role not in ROLE_SCHEMAS:
            raise AttributeError(role)
        if role == "exchange_rate":
            return exchange_rate(self._spark)
        return self._spark.read.schema(ROLE_SCHEMAS[role]).parquet(self._path(role))

    def _path(self, role: str) -> str:
        key = (self._spark.sparkContext.applicationId, self._sf_dir, role)
        with _lock:
            if key not in _stored:
                path = new_stage_path(self._spark, role)
                text = role_sql(SparkDialect)[role]
                for table in STAR_TABLES:
                    if f"FROM {table}" in text:
                        text = text.replace(f"FROM {table}", f"FROM {self._view(table)}")
                with open_folders(self._spark):
                    self._spark.sql(text).write.partitionBy(*PARTITIONED_BY.get(role, [])).parquet(path)
                _stored[key] = path
        return _stored[key]


    def _view(self, table: str) -> str:
        """The given table as a view."""
        name = f"star_{table}"
        read_star(self._spark, self._sf_dir, table).createOrReplaceTempView(name)
        return name


def bronze_from_star(spark: SparkSession, sf_dir: str) -> StarBronze:
    return StarBronze(spark, sf_dir)
