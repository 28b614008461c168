"""Query registry, the warehouse the queries run on, and the SQL building blocks of the oracles."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tillstar import schemas
from tillstar.plans import warehouse
from tillstar.session import shared_folder
from tillstar.sources import adapters
from tillstar.sources.tables import TableStore

SALES_AS_OF = dt.date(2001, 8, 1)
CAMPAIGN_AS_OF = dt.date(2024, 1, 31)
FIRST_LOAD = dt.date(1998, 1, 1)
SECOND_LOAD = dt.date(1999, 6, 1)

STAGED = (
    "stg_crm_customers", "stg_customers_first", "stg_customers_second", "stg_products", "stg_products_second",
    "stg_ecom_transactions", "stg_ecom_transaction_items", "stg_marketing_campaigns", "stg_campaign_responses",
)

_BUILT: dict[tuple[str, str], set[str]] = {}
_LOCK = threading.RLock()


class Context:
    """Staging and warehouse tables derived from one folder of test tables.

    Tables are written to the shared folder on first use, once per application and folder,
    as a warehouse would, and only those that a query asks for; queries then read only the columns and files they need.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        app = spark.sparkContext.applicationId
        self._built = _BUILT.setdefault((app, self.folder), set())
        digest = hashlib.md5(self.folder.encode()).hexdigest()[:12]
        self.root = f"{shared_folder(spark)}/{app}-{digest}"
        self.staging = TableStore(spark, f"{self.root}/staging")
        self.store = TableStore(spark, f"{self.root}/warehouse")

    def scratch(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def once(self, name: str, build: Callable[[], object]) -> None:
        with _LOCK:
            if name not in self._built:
                build()
                self._built.add(name)

    def stg(self, name: str) -> DataFrame:
        self.once(
            name, lambda: self.staging.replace(adapters.staged(self.spark, self.folder, name), name)
        )
        return self.staging.read(name)

    def passing(self, name: str) -> DataFrame:
        """Staged rows for a step that goes over them once: of the stored table if it is there, else computed on the way."""
        return self.stg(name) if name in self._built else adapters.staged(self.spark, self.folder, name)

    def staged(self, customers: str = "stg_crm_customers") -> dict[str, DataFrame]:
        names = ("stg_products", "stg_ecom_transactions", "stg_ecom_transaction_items",
                 "stg_marketing_campaigns", "stg_campaign_responses")
        return {n: self.stg(n) for n in names} | {"stg_crm_customers": self.stg(customers)}

    def _build_dimensions(self) -> None:
        staged = {n: self.stg(n) for n in ("stg_products", "stg_marketing_campaigns")}
        warehouse.load_dimensions(self.store, staged | {"stg_crm_customers": self.stg("stg_customers_first")}, FIRST_LOAD)
        TableStore(self.spark, f"{self.root}/kept").replace(self.store.read("dim_customer"), "first_load")
        warehouse.load_customers(self.store, self.stg("stg_customers_second"), SECOND_LOAD)
        TableStore(self.spark, f"{self.root}/kept").replace(self.store.read("dim_customer"), "second_load")

    def _build_dates(self) -> None:
        self.once("dimensions", self._build_dimensions)
        warehouse.cover_dates(self.store, self.passing("stg_ecom_transactions"), "transaction_date")
        warehouse.cover_dates(self.store, self.passing("stg_campaign_responses"), "response_date")

    def _build_transactions(self) -> None:
        self.once("dimensions", self._build_dimensions)
        warehouse.load_transactions(
            self.store, self.passing("stg_ecom_transactions"), self.passing("stg_ecom_transaction_items"))

    def _build_responses(self) -> None:
        self.once("dimensions", self._build_dimensions)
        warehouse.load_responses(self.store, self.passing("stg_campaign_responses"))

    def _build_metrics(self) -> None:
        self.once("transactions", self._build_transactions)
        warehouse.refresh_metrics(self.store)

    def _build_aggregates(self) -> None:
        self.once("transactions", self._build_transactions)
        warehouse.build_aggregates(self.store)

    def dim(self, name: str) -> DataFrame:
        """A dimension before any sales metrics are set."""
        self.once("dimensions", self._build_dimensions)
        if name == "dim_customer":
            return TableStore(self.spark, f"{self.root}/kept").read("second_load")
        return self.store.read(name)

    def first_load(self) -> DataFrame:
        """The customer dimension after the first snapshot only."""
        self.once("dimensions", self._build_dimensions)
        return TableStore(self.spark, f"{self.root}/kept").read("first_load")

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        return _Tables(self)

    def __getitem__(self, name: str) -> DataFrame:
        """A warehouse table. What it is made of is built on first use, and nothing else."""
        steps = {
            "dim_customer": ("metrics", self._build_metrics),
            "dim_date": ("dates", self._build_dates),
            "fact_transactions": ("transactions", self._build_transactions),
            "fact_campaign_responses": ("responses", self._build_responses),
            "agg_customer_monthly": ("aggregates", self._build_aggregates),
            "agg_product_daily": ("aggregates", self._build_aggregates),
        }
        self.once(*steps.get(name, ("dimensions", self._build_dimensions)))
        return self.store.read(name)


class _Tables(Mapping[str, DataFrame]):
    """The warehouse tables of a context by name, each built when it is asked for."""

    def __init__(self, context: Context):
        self._context = context

    def __getitem__(self, name: str) -> DataFrame:
        if name not in schemas.WAREHOUSE:
            raise KeyError(name)
        return self._context[name]

    def __iter__(self) -> Iterator[str]:
        return iter(schemas.WAREHOUSE)

    def __len__(self) -> int:
        return len(schemas.WAREHOUSE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of a Context under ``name``, with the SQL that must give the same rows."""

    def register(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Context(spark, folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def sql_round(x: str, digits: int = 2) -> str:
    """Half-up rounding spelled in plain double steps."""
    scale = f"{10**digits}e0"
    return f"(sign({x}) * (floor(abs({x}) * {scale} + 0.5e0) / {scale}))"


def sql_ratio(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0e0))"


def sql_percent(num: str, den: str, digits: int | None = 2) -> str:
    value = f"(cast({num} as double) * 100e0 / nullif(cast({den} as double), 0e0))"
    return value if digits is None else sql_round(value, digits)


def sql_money(x: str) -> str:
    return f"cast({x} as decimal(28,2))"


# Views of the oracle by name; each may refer to the views before it.
CTES: dict[str, str] = {}


def _view_text(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", adapters.VIEWS[name])


for _name in adapters.VIEWS:
    CTES[_name] = _view_text(_name)


def define(name: str, text: str) -> None:
    CTES[name] = text


def oracle_text(body: str) -> str:
    """The query preceded by exactly the views it needs, in order of dependency."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b\w+\b", text)):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed[name] = CTES[name]

    visit(body)
    if not needed:
        return body
    views = ",\n".join(f"{n} as ({t})" for n, t in needed.items())
    return f"with {views}\n{body}"


# --- the warehouse in SQL -------------------------------------------------------------------

_TRACKED = ("address", "city", "state", "postal_code", "customer_segment")
_CUSTOMER = (
    "customer_id, first_name, last_name, full_name, email, phone_number, date_of_birth, age, age_group, gender, "
    "address, city, state, postal_code, country, registration_date, customer_segment, account_status"
)


def _customers(view: str, as_of: dt.date) -> str:
    return f"""
        select q.*, first_name || ' ' || last_name as full_name,
               case when age > 0 and age <= 25 then '18-25' when age > 25 and age <= 35 then '26-35'
                    when age > 35 and age <= 45 then '36-45' when age > 45 and age <= 55 then '46-55'
                    when age > 55 and age <= 65 then '56-65' when age > 65 and age <= 100 then '65+'
                    else 'nan' end as age_group
        from (select *, cast(floor(datediff('day', date_of_birth, date '{as_of}') / 365e0) as int) as age,
                     row_number() over (partition by customer_id order by load_day desc) as latest
              from {view}) q
        where latest = 1"""


define("first_snapshot", _customers("stg_customers_first", FIRST_LOAD))
define("second_snapshot", _customers("stg_customers_second", SECOND_LOAD))
define("whole_snapshot", _customers("stg_crm_customers", FIRST_LOAD))
define("customers_initial", f"""
    select row_number() over (order by customer_id) as customer_key, {_CUSTOMER},
           registration_date as valid_from, date '9999-12-31' as valid_to, true as is_current
    from first_snapshot""")
define("change_labels", """
    select s.customer_id,
           case when c.customer_id is null then 'new'
                when """ + " or ".join(f"s.{c} is distinct from c.{c}" for c in _TRACKED) + """ then 'scd2_changed'
                when s.email is distinct from c.email or s.phone_number is distinct from c.phone_number
                     then 'type1_changed'
                else 'unchanged' end as change
    from second_snapshot s left join customers_initial c on s.customer_id = c.customer_id""")
define("customers_merged", f"""
    select c.* replace (
               case when l.change = 'type1_changed' then s.email else c.email end as email,
               case when l.change = 'type1_changed' then s.phone_number else c.phone_number end as phone_number,
               case when l.change = 'scd2_changed' then date '{SECOND_LOAD}' else c.valid_to end as valid_to,
               coalesce(l.change, '') <> 'scd2_changed' as is_current)
    from customers_initial c
    left join change_labels l on c.customer_id = l.customer_id
    left join second_snapshot s on c.customer_id = s.customer_id
    union all
    select (select max(customer_key) from customers_initial) + row_number() over (order by s.customer_id),
           {', '.join('s.' + c for c in _CUSTOMER.split(', '))},
           case when l.change = 'new' then s.registration_date else date '{SECOND_LOAD}' end,
           date '9999-12-31', true
    from second_snapshot s join change_labels l on s.customer_id = l.customer_id
    where l.change in ('new', 'scd2_changed')""")
define("dim_product", """
    select row_number() over (order by product_id) as product_key, product_id, product_name, product_category,
           product_subcategory, brand, unit_cost, retail_price,
           cast(""" + sql_percent("retail_price - unit_cost", "retail_price") + """ as decimal(9,2)) as margin_percentage,
           product_status, product_status = 'Active' as is_active
    from stg_products""")
define("dim_campaign", """
    select row_number() over (order by campaign_id) as campaign_key, campaign_id, campaign_name, campaign_type,
           channel, start_date, end_date, cast(datediff('day', start_date, end_date) as int) as duration_days,
           budget, target_audience, campaign_status
    from stg_marketing_campaigns""")
define("dim_date", """
    select cast(strftime(d, '%Y%m%d') as int) as date_key, d as date_actual,
           cast(dayofweek(d) as int) as day_of_week, dayname(d) as day_name,
           cast(day(d) as int) as day_of_month, cast(dayofyear(d) as int) as day_of_year,
           cast(weekofyear(d) as int) as week_of_year,
           cast(date_trunc('week', d) as date) as week_start_date,
           cast(date_trunc('week', d) as date) + 6 as week_end_date,
           cast(month(d) as int) as month_number, monthname(d) as month_name, strftime(d, '%b') as month_abbr,
           cast(date_trunc('month', d) as date) as month_start_date, last_day(d) as month_end_date,
           cast(quarter(d) as int) as quarter_number, 'Q' || cast(quarter(d) as varchar) as quarter_name,
           cast(date_trunc('quarter', d) as date) as quarter_start_date,
           cast(date_trunc('quarter', d) + interval 3 month - interval 1 day as date) as quarter_end_date,
           cast(year(d) as int) as year_number, cast(year(d) as int) as fiscal_year,
           cast(quarter(d) as int) as fiscal_quarter, cast(month(d) as int) as fiscal_month,
           dayofweek(d) in (0, 6) as is_weekend, false as is_holiday, cast(null as varchar) as holiday_name,
           dayofweek(d) not in (0, 6) as is_business_day
    from (select cast(unnest(generate_series(timestamp '1995-01-01', timestamp '2030-12-31', interval 1 day)) as date) as d)""")


def _fact_sql(customers: str, upper: str = "<", kind: str = "join") -> str:
    return f"""
        select row_number() over (order by transaction_date_key, transaction_id, product_key, quantity, unit_price,
                                  line_total, discount_amount, customer_key) as transaction_key, *
        from (select c.customer_key, p.product_key,
                     cast(strftime(t.transaction_date, '%Y%m%d') as int) as transaction_date_key,
                     t.transaction_id, t.order_number, i.quantity, i.unit_price, i.line_total, i.discount_amount,
                     t.tax_amount, t.shipping_amount,
                     cast(i.line_total - i.discount_amount as decimal(12,2)) as net_amount,
                     t.payment_method, t.payment_status, t.currency_code
              from stg_ecom_transactions t
              join stg_ecom_transaction_items i on t.transaction_id = i.transaction_id
              {kind} {customers} c on t.customer_id = c.customer_id
                   and t.transaction_date >= c.valid_from and t.transaction_date {upper} c.valid_to
              join dim_product p on i.product_id = p.product_id) lines"""


define("fact_transactions", _fact_sql("customers_merged"))
define("fact_initial", _fact_sql("customers_initial"))
define("fact_inclusive", _fact_sql("customers_merged", "<="))
define("fact_campaign_responses", """
    select row_number() over (order by r.response_id, c.customer_key) as response_key, c.customer_key, k.campaign_key,
           cast(strftime(r.response_date, '%Y%m%d') as int) as response_date_key, r.response_id, r.response_type,
           r.conversion_value, r.response_type = 'opened' as is_opened, r.response_type = 'clicked' as is_clicked,
           r.response_type = 'converted' as is_converted
    from stg_campaign_responses r
    join customers_merged c on r.customer_id = c.customer_id
         and r.response_date >= c.valid_from and r.response_date < c.valid_to
    join dim_campaign k on r.campaign_id = k.campaign_id""")
define("version_sales", """
    select customer_key, count(distinct transaction_id) as orders, cast(sum(net_amount) as decimal(28,2)) as spent
    from fact_transactions group by customer_key""")
define("dim_customer", f"""
    select c.customer_key, {', '.join('c.' + c for c in _CUSTOMER.split(', '))},
           case when c.is_current and m.orders is not null then m.spent else cast(0 as decimal(28,2)) end as lifetime_value,
           case when c.is_current and m.orders is not null then m.orders else 0 end as total_orders,
           case when c.is_current and m.orders is not null then m.spent else cast(0 as decimal(28,2)) end as total_spent,
           c.valid_from, c.valid_to, c.is_current
    from customers_merged c left join version_sales m on c.customer_key = m.customer_key""")
define("dated_sales", """
    select f.*, d.* from fact_transactions f join dim_date d on f.transaction_date_key = d.date_key""")
