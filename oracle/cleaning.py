"""DuckDB oracle for the cleaning pipelines: raw views -> cleaned tables as CTE chains.

``CLEAN_CTES[table]`` is a list of (name, sql) CTEs ending in ``c_<table>``; other oracle
modules build marts on top of them.
"""

from __future__ import annotations

from oracle.fixtures import RETAIL_VIEWS, with_ctes
from souk.operators.clean import NA_TOKENS
from souk.sources.raw import RAW_SPECS, raw_sql

TOKENS = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS) + ")"


def _alias(expr: str) -> str:
    return expr.rsplit(" AS ", 1)[-1].strip() if " AS " in expr else expr.strip()


class Chain:
    """Builds CTE steps while tracking the column list."""

    def __init__(self, table: str):
        self.table = table
        self.ctes: list[tuple[str, str]] = []
        spec = RAW_SPECS[table]
        self.cols = [_alias(e) for e in spec.select] + ["source_row_order"]
        self._n = 0
        self._add(raw_sql(table))
        # reading: NA tokens -> NULL on every text column
        self.select({c: f"CASE WHEN {c} IN {TOKENS} THEN NULL ELSE {c} END" for c in self.cols if c != "source_row_order"})

    @property
    def prev(self) -> str:
        return self.ctes[-1][0]

    def _add(self, sql: str) -> None:
        self._n += 1
        self.ctes.append((f"{self.table}_s{self._n}", sql))

    def select(self, replace: dict[str, str], where: str | None = None, cols: list[str] | None = None) -> None:
        cols = cols or self.cols
        items = [f"{replace.get(c, c)} AS {c}" for c in cols]
        sql = f"SELECT {', '.join(items)} FROM {self.prev}"
        if where:
            sql += f" WHERE {where}"
        self.cols = list(cols)
        self._add(sql)

    def rename(self, mapping: dict[str, str]) -> None:
        items = [f"{c} AS {mapping.get(c, c)}" for c in self.cols]
        self.cols = [mapping.get(c, c) for c in self.cols]
        self._add(f"SELECT {', '.join(items)} FROM {self.prev}")

    def numeric(self, cols) -> None:
        self.select({c: f"TRY_CAST(trim({c}) AS DOUBLE)" for c in cols if c in self.cols})

    def dates(self, cols) -> None:
        self.select({c: f"TRY_CAST(trim({c}) AS TIMESTAMP)" for c in cols if c in self.cols})

    def median_fill(self, cols) -> None:
        p = self.prev
        self.select({c: f"COALESCE({c}, (SELECT median({c}) FROM {p}), 0.0)" for c in cols if c in self.cols})

    def mode_fill(self, cols, default: str) -> None:
        p = self.prev
        rep = {}
        for c in cols:
            if c not in self.cols:
                continue
            mode = (f"(SELECT CAST({c} AS VARCHAR) FROM {p} WHERE {c} IS NOT NULL "
                    f"GROUP BY CAST({c} AS VARCHAR) ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)")
            rep[c] = f"COALESCE(CAST({c} AS VARCHAR), {mode}, '{default}')"
        self.select(rep)

    def dropna(self, cols) -> None:
        self.select({}, where=" AND ".join(f"{c} IS NOT NULL" for c in cols))

    def dedupe(self, keys) -> None:
        rest = [c for c in self.cols if c not in keys and c != "source_row_order"]
        order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["source_row_order", *rest])
        self._add(f"SELECT * FROM {self.prev} QUALIFY ROW_NUMBER() OVER "
                  f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")

    def half_even(self, cols) -> None:
        self.select({c: f"CAST(ROUND_EVEN({c}, 0) AS BIGINT)" for c in cols})

    def zip(self, col: str) -> None:
        self.select({col: f"COALESCE(regexp_replace(CAST({col} AS VARCHAR), '\\.0$', ''), '00000')"})

    def finish(self) -> list[tuple[str, str]]:
        cols = [c for c in self.cols if c != "source_row_order"]
        self.cols = cols
        self.ctes.append((f"c_{self.table}", f"SELECT {', '.join(cols)} FROM {self.prev}"))
        return self.ctes


def _customers():
    c = Chain("customers")
    c.dedupe(["customer_id"])
    c.mode_fill(["customer_city", "customer_state"], "Unknown")
    c.zip("customer_zip_code_prefix")
    return c.finish()


def _geolocation():
    z = "geolocation_zip_code_prefix"
    c = Chain("geolocation")
    c.numeric(["geolocation_lat", "geolocation_lng"])
    c.mode_fill(["geolocation_city", "geolocation_state"], "Unknown")
    c.zip(z)
    cols = [x for x in c.cols if x != "source_row_order"]
    base = "c_geolocation_rows"
    ctes = c.ctes + [(base, f"SELECT DISTINCT {', '.join(cols)} FROM {c.prev}")]

    def mode(col):
        return (f"(SELECT {col} FROM (SELECT {col}, COUNT(*) AS n FROM {base} g2 WHERE g2.{z} = g.{z} "
                f"AND {col} IS NOT NULL GROUP BY {col}) ORDER BY n DESC, {col} LIMIT 1)")

    ctes.append(("c_geolocation", f"""
        SELECT {z}, AVG(geolocation_lat) AS geolocation_lat, AVG(geolocation_lng) AS geolocation_lng,
               COALESCE({mode('geolocation_city')}, 'Unknown') AS geolocation_city,
               COALESCE({mode('geolocation_state')}, 'Unknown') AS geolocation_state
        FROM {base} g GROUP BY {z}"""))
    return ctes


def _order_items():
    c = Chain("order_items")
    c.numeric(["order_item_id", "price", "freight_value"])
    c.dates(["shipping_limit_date"])
    c.median_fill(["order_item_id", "price", "freight_value"])
    c.dropna(["order_id", "product_id", "seller_id"])
    c.dedupe(["order_id", "order_item_id"])
    c.half_even(["order_item_id"])
    return c.finish()


def _order_payments():
    num = ["payment_sequential", "payment_installments", "payment_value"]
    c = Chain("order_payments")
    c.numeric(num)
    c.median_fill(num)
    c.mode_fill(["payment_type"], "Unknown")
    c.dropna(["order_id"])
    c.dedupe(["order_id", "payment_sequential"])
    c.half_even(["payment_sequential", "payment_installments"])
    return c.finish()


def _order_reviews():
    c = Chain("order_reviews")
    c.numeric(["review_score"])
    c.dates(["review_creation_date", "review_answer_timestamp"])
    c.median_fill(["review_score"])
    c.mode_fill(["review_comment_title", "review_comment_message"], "")
    c.dropna(["order_id"])
    c.dedupe(["review_id"])
    c.half_even(["review_score"])
    return c.finish()


def _orders():
    c = Chain("orders")
    c.dates(["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"])
    c.mode_fill(["order_status"], "unknown")
    c.dropna(["order_id", "customer_id"])
    c.dedupe(["order_id"])
    return c.finish()


PRODUCT_NUMERIC = ["product_name_length", "product_description_length", "product_photos_qty", "product_weight_g",
                   "product_length_cm", "product_height_cm", "product_width_cm"]


def _products():
    c = Chain("products")
    c.rename({"product_name_lenght": "product_name_length",
              "product_description_lenght": "product_description_length"})
    c.numeric(PRODUCT_NUMERIC)
    c.median_fill(PRODUCT_NUMERIC)
    c.mode_fill(["product_category_name"], "unknown_category")
    c.dedupe(["product_id"])
    return c.finish()


def _sellers():
    c = Chain("sellers")
    c.mode_fill(["seller_city", "seller_state"], "Unknown")
    c.zip("seller_zip_code_prefix")
    c.dedupe(["seller_id"])
    return c.finish()


def _category_translation():
    c = Chain("category_translation")
    c.mode_fill(["product_category_name", "product_category_name_english"], "Unknown")
    c.dedupe(["product_category_name"])
    return c.finish()


CLEAN_CTES = {
    "customers": _customers(),
    "geolocation": _geolocation(),
    "order_items": _order_items(),
    "order_payments": _order_payments(),
    "order_reviews": _order_reviews(),
    "orders": _orders(),
    "products": _products(),
    "sellers": _sellers(),
    "category_translation": _category_translation(),
}


def retail_ctes_for(tables) -> list[tuple[str, str]]:
    """Retail view CTEs needed by the given raw tables."""
    needed = []
    for t in tables:
        src = "r_" + RAW_SPECS[t].source
        if src not in needed:
            needed.append(src)
    return [(n, RETAIL_VIEWS[n]) for n in needed]


def cleaned_ctes(*tables: str) -> list[tuple[str, str]]:
    out = retail_ctes_for(tables)
    for t in tables:
        out.extend(CLEAN_CTES[t])
    return out


Q = {}
for _t in CLEAN_CTES:
    Q[f"clean_{_t}"] = with_ctes(f"SELECT * FROM c_{_t}", *cleaned_ctes(_t))
    Q[f"io_csv_{_t}"] = Q[f"clean_{_t}"]
