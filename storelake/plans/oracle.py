"""Independent SQL for the registered queries, over the same tables."""

CUSTOMERS = """
select c_name as customer_id, cast(18 + c_custkey % 60 as int) as age,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as gender, n_name as country,
       cast(date '2020-01-01' + cast(c_custkey % 900 as int) as varchar) as registration_date,
       c_acctbal / 100 as loyalty_score, c_acctbal as lifetime_value,
       cast(c_custkey % 2 as int) as churn_label
from customer join nation on c_nationkey = n_nationkey
"""

PRODUCTS = """
select cast(p_partkey as varchar) as product_id, p_type as category, p_retailprice as price,
       cast(p_size as double) / 100 as margin_percentage, cast(p_size as double) as popularity_score
from part
"""

TRANSACTIONS = """
select concat('T', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as transaction_id,
       concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0')) as customer_id,
       cast(l_partkey as varchar) as product_id,
       cast(cast(o_orderdate as date) as varchar) as order_date,
       l_extendedprice as order_value, o_orderpriority as payment_method,
       l_returnflag as device_type, l_discount as discount_applied,
       cast(cast(l_shipdate as date) - cast(o_orderdate as date) as int) as shipping_delay_days,
       case when l_linestatus = 'F' then 1 else 0 end as fraud_label
from lineitem join orders on l_orderkey = o_orderkey
"""

BEHAVIOR = """
select concat('Customer#', lpad(cast(user_id as varchar), 9, '0')) as customer_id,
       max(value) as avg_session_time, cast(count(*) as int) as pages_per_session,
       min(value) / 500 as cart_abandon_rate,
       cast(count(case when event_type = 'error' then 1 end) as double) / count(*) as return_rate,
       cast(count(case when event_type = 'error' then 1 end) as int) as support_tickets,
       cast(user_id % 5 + 1 as double) as review_score,
       cast(user_id % 2 as int) as behavior_churn_signal
from events group by user_id
"""

EVENT_FIELDS = """
select event_id, ts, event_type, value,
       concat('Customer#', lpad(cast(user_id as varchar), 9, '0')) as customer_id,
       json_extract_string(props, '$.k') as product_id,
       cast(cast(ts as date) as varchar) as order_date,
       case event_type when 'view' then 'UPI' when 'click' then 'Debit Card' when 'signup' then 'PayPal'
            when 'purchase' then 'Credit Card' else 'Cash' end as payment_method,
       cast(day(ts) as int) as ts_day
from events
"""

REQUESTED = """
select event_id as request_id, 0 as index,
       case when event_type <> 'signup' then concat('E', cast(event_id as varchar)) end as transaction_id,
       customer_id, product_id, order_date, value * 50 as order_value, payment_method,
       event_type as device_type, value / 1000 as discount_applied, ts_day as shipping_delay_days
from event_fields
union all
select event_id, 1, concat('S', cast(event_id as varchar)),
       case when value >= 5 then customer_id else '' end, product_id, '', value, 'UPI',
       null, null, null
from event_fields
"""

JUDGED = """
select *,
       case when customer_id = '' then 'Missing required field: customer_id' end as m1,
       case when order_value <= 0 then 'order_value must be greater than 0'
            when order_value > 10000 then 'order_value must be less than 10000' end as m2,
       case when payment_method not in ('UPI', 'Debit Card', 'Credit Card', 'PayPal', 'Crypto')
            then 'payment_method must be one of: UPI, Debit Card, Credit Card, PayPal, Crypto' end as m3
from requested
"""

BUILT = """
select coalesce(transaction_id,
                concat('TXN', upper(sha256(concat_ws('|', cast(request_id as varchar),
                       cast(index as varchar), customer_id, product_id))))) as transaction_id,
       customer_id, product_id,
       case when order_date = '' then '2024-07-01' else order_date end as order_date,
       round(order_value, 2) as order_value, payment_method,
       coalesce(device_type, 'Unknown') as device_type,
       coalesce(discount_applied, 0.0) as discount_applied,
       coalesce(shipping_delay_days, 0) as shipping_delay_days,
       case when round(order_value, 2) > 950 then 1 else 0 end as high_value_flag
from judged j
where not exists (select 1 from judged bad where bad.request_id = j.request_id
                  and (bad.m1 is not null or bad.m2 is not null or bad.m3 is not null))
"""

STREAMED = """
select event_id as seq, concat(customer_id, '-', product_id) as transaction_id, customer_id, product_id,
       order_date, value * 10 as order_value, payment_method,
       case when event_type <> 'view' then event_type end as device_type,
       value / 1000 as discount_applied, ts_day as shipping_delay_days,
       case when value * 10 > 950 then 1 else 0 end as high_value_flag
from event_fields
"""

ITEMS = """
select seq, transaction_id, customer_id, product_id, order_date, cast(order_value as varchar) as order_value,
       payment_method, coalesce(device_type, 'UNKNOWN') as device_type, discount_applied,
       shipping_delay_days, high_value_flag, '2024-07-01T12:30:00.000000' as ingested_at
from streamed
"""

LATEST = """
select * from items
where seq in (select max(seq) from items group by transaction_id)
"""

CHANGES = """
select case event_type when 'click' then 'MODIFY' else 'INSERT' end as event_name,
       concat('E', cast(event_id as varchar)) as transaction_id, customer_id, product_id, order_date,
       value as order_value, payment_method, cast(null as varchar) as device_type,
       value / 1000 as discount_applied, ts_day as shipping_delay_days,
       case when value > 95 then 1 else 0 end as high_value_flag
from event_fields where event_type not in ('error', 'signup')
"""

SHAPES = """
select event_id as request_id,
       case when event_type = 'click' then 'transactions list is empty'
            when event_type = 'signup' then 'transactions must be a list'
            when event_type = 'purchase' and value > 50 then 'Maximum 100 transactions per request'
            when event_type = 'purchase' then 'Request body must contain a ''transactions'' list'
            when event_type = 'error' then 'Invalid JSON in request body' end as shape_error
from events
"""

DIM_CUSTOMER = """
select customer_key, customer_id, age, gender, country, registration_date,
       loyalty_score, lifetime_value, churn_label
from (select sha256(customer_id) as customer_key, customer_id, age, gender, country,
             try_cast(registration_date as date) as registration_date, loyalty_score, lifetime_value, churn_label,
             row_number() over (partition by customer_id order by age, gender, country, registration_date,
                                loyalty_score, lifetime_value, churn_label) as rank
      from customers)
where rank = 1
"""

DIM_PRODUCT = """
select product_key, product_id, category, price, margin_percentage, popularity_score
from (select sha256(product_id) as product_key, product_id, category, price, margin_percentage, popularity_score,
             row_number() over (partition by product_id order by category, price, margin_percentage,
                                popularity_score) as rank
      from products)
where rank = 1
"""

DIM_PAYMENT = """
select distinct sha256(payment_method) as payment_method_key, payment_method
from transactions where payment_method is not null
"""

DIM_DATE = """
select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date, cast(day(d) as int) as day,
       cast(month(d) as int) as month, monthname(d) as month_name, cast(quarter(d) as int) as quarter,
       cast(year(d) as int) as year, dayname(d) as day_of_week, dayofweek(d) in (0, 6) as is_weekend
from (select distinct try_cast(order_date as date) as d from transactions)
where d is not null
"""

_FACT_TRANSACTIONS = """
select customer_key, product_key, payment_method_key,
       cast(strftime(cast(order_date as date), '%Y%m%d') as int) as date_key,
       transaction_id, t.customer_id, t.product_id, t.payment_method, order_value, discount_applied,
       {net_value} as net_value, shipping_delay_days, fraud_label, device_type,
       '{load_type}' as load_type, '2024-07-01T12:30:00.000000' as ingested_at
from {transactions} t
left join (select * from dim_customer where {customer}) c on t.customer_id = c.customer_id
left join (select * from dim_product where {product}) p on t.product_id = p.product_id
left join dim_payment m on t.payment_method = m.payment_method
"""

_SHORT = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "behavior": BEHAVIOR,
    "event_fields": EVENT_FIELDS,
    "requested": REQUESTED,
    "judged": JUDGED,
    "built": BUILT,
    "streamed": STREAMED,
    "items": ITEMS,
    "latest": LATEST,
    "changes": CHANGES,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_payment": DIM_PAYMENT,
}

# The transactions as declared for files: 32-bit floats.
FLOAT_TRANSACTIONS = """
select transaction_id, customer_id, product_id, order_date, cast(order_value as float) as order_value,
       payment_method, device_type, cast(discount_applied as float) as discount_applied,
       shipping_delay_days, fraud_label
from transactions
"""

ITEM_COLUMNS = """transaction_id, customer_id, product_id, order_date, order_value, payment_method, device_type,
       discount_applied, shipping_delay_days, high_value_flag"""


def with_views(names: str, body: str, **extra: str) -> str:
    """Prefix ``body`` with the named views, in order, and any extra ones after them."""
    views = {**{name: _SHORT[name] for name in names.split()}, **extra}
    listed = ",\n".join(f"{name} as ({text.strip()})" for name, text in views.items())
    return f"with {listed}\n{body.strip()}"


_REQUEST_VIEWS = "event_fields requested judged"
_FLOAT_FACT = {
    "net_value": "order_value * (cast(1 as float) - discount_applied)",
    "transactions": "float_transactions",
}

_KNOWN = {"customer": "lifetime_value > 3000", "product": "popularity_score <= 25"}
_ALL = {"customer": "true", "product": "true"}

_FLOAT_BEHAVIOR = """
select customer_id, cast(avg_session_time as float) as avg_session_time, pages_per_session,
       cast(cart_abandon_rate as float) as cart_abandon_rate, cast(return_rate as float) as return_rate,
       support_tickets, cast(review_score as float) as review_score, behavior_churn_signal
from behavior
"""

# The dimensions of a load: what passes a condition, with 32-bit floats.
_LOADED = {
    "dim_customer": """
        select sha256(customer_id) as customer_key, customer_id, age, gender, country,
               cast(registration_date as date) as registration_date, cast(loyalty_score as float) as loyalty_score,
               cast(lifetime_value as float) as lifetime_value, churn_label
        from customers where {customer}
    """,
    "dim_product": """
        select sha256(product_id) as product_key, product_id, category, cast(price as float) as price,
               cast(margin_percentage as float) as margin_percentage, cast(popularity_score as float) as popularity_score
        from products where {product}
    """,
    "dim_payment": DIM_PAYMENT,
    "dim_date": DIM_DATE,
}
_LOADED_VIEWS = "customers products behavior transactions"
_LATER = {
    "customer": """customer_id in (select customer_id from behavior) or customer_id >
        (select max(b.customer_id) from behavior b join customers a on a.customer_id = b.customer_id)""",
    "product": "price < 950 or product_id > (select max(product_id) from products where price < 950)",
}

ORACLES = {
    "dim_customer": with_views("customers", DIM_CUSTOMER.replace("from customers)", """from (
          select * replace (case when age % 5 <> 0 then registration_date else 'unknown' end as registration_date)
          from (select * from customers
                union all select * replace (loyalty_score + 1 as loyalty_score) from customers where gender = 'F')))""")),
    "dim_product": with_views("products", DIM_PRODUCT),
    "dim_payment": with_views("transactions", DIM_PAYMENT),
    "dim_date": with_views("transactions", DIM_DATE),
    "fact_transactions": with_views(
        "customers products transactions dim_customer dim_product dim_payment",
        _FACT_TRANSACTIONS.format(
            net_value="order_value * (1 - discount_applied)", load_type="INITIAL", transactions="transactions", **_KNOWN
        ),
    ),
    "fact_behavior": with_views(
        "customers behavior dim_customer",
        """
        select customer_key, b.*, 'INITIAL' as load_type, '2024-07-01T12:30:00.000000' as ingested_at
        from behavior b left join (select * from dim_customer where lifetime_value > 3000) c
        on b.customer_id = c.customer_id
        """,
    ),
    "join_left_customer": with_views(
        "customers transactions",
        """
        select transaction_id, t.customer_id, order_value,
               case when c.customer_id is not null then sha256(c.customer_id) end as customer_key
        from transactions t left join (select distinct customer_id from customers where lifetime_value > 3000) c
        on t.customer_id = c.customer_id
        """,
    ),
    "join_left_product": with_views(
        "products transactions",
        """
        select transaction_id, t.product_id, order_value,
               case when p.product_id is not null then sha256(p.product_id) end as product_key
        from transactions t left join (select distinct product_id from products where popularity_score <= 25) p
        on t.product_id = p.product_id
        """,
    ),
    "join_left_payment": with_views(
        "transactions",
        """
        select transaction_id, payment_method, order_value, sha256(payment_method) as payment_method_key
        from transactions
        """,
    ),
    "clean_rows": """
        select distinct user_id, event_type, cast(floor(value / 10) as bigint) as value_band
        from events where value >= 5
    """,
    "clean_names": "select event_id, ts, user_id, event_type, value, props from events",
    "dedup_by_key": """
        select * exclude (rank) from (
            select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) as rank
            from lineitem)
        where rank = 1
    """,
    "cast_to_schema": with_views(
        "customers",
        """
        select customer_id, age, gender, country, registration_date,
               case when loyalty_score >= 0 then cast(loyalty_score as float) end as loyalty_score,
               cast(lifetime_value as float) as lifetime_value, churn_label
        from customers
        """,
    ),
    "prj_select": with_views(
        "transactions", "select transaction_id, customer_id, order_date, order_value, fraud_label from transactions"
    ),
    "lineage_cols": with_views(
        "products",
        "select *, 'INCREMENTAL' as load_type, '2024-07-01T12:30:00.000000' as ingested_at from products",
    ),
    "agg_max_key": with_views(
        "transactions",
        "select max(customer_id) as max_customer_id, max(product_id) as max_product_id from transactions",
    ),
    "incr_watermark_customers": with_views(
        "customers behavior",
        "select * from customers where customer_id > (select max(customer_id) from behavior)",
    ),
    "incr_watermark_products": with_views(
        "products",
        "select * from products where product_id > (select max(product_id) from products where price < 950)",
    ),
    "incr_watermark_numeric": with_views(
        "products",
        """
        select * from products where cast(product_id as bigint) >
            (select max(cast(product_id as bigint)) from products where price < 950)
        """,
    ),
    "incr_anti_behavior": with_views(
        "customers behavior",
        """
        select * from customers c
        where not exists (select 1 from behavior b where b.customer_id = c.customer_id)
        """,
    ),
    "src_csv_typed": with_views("transactions", FLOAT_TRANSACTIONS),
    "src_parquet": "select * from part",
    "sink_parquet_overwrite": with_views("transactions", "select * from transactions"),
    "sink_parquet_append": with_views("products", "select * from products"),
    "sink_append_nonempty": with_views(
        "products",
        """
        select p.*, (select count(*) from products where product_id > last_id) as first_delta,
               cast(0 as bigint) as second_delta
        from products p, (select max(product_id) as last_id from products where price < 950)
        where price < 950
        union all
        select p.*, (select count(*) from products where product_id > last_id), 0
        from products p, (select max(product_id) as last_id from products where price < 950)
        where product_id > last_id
        """,
    ),
    "sink_csv_extract": "select * from documents",
    "sink_csv_fixed": with_views(
        "event_fields streamed items",
        f"select {ITEM_COLUMNS.replace('order_value', 'cast(order_value as double) as order_value')} from items",
    ),
    "ingest_explode": with_views(
        "event_fields requested",
        "select * replace (cast(shipping_delay_days as varchar) as shipping_delay_days) from requested",
    ),
    "validate_required": with_views(
        _REQUEST_VIEWS,
        "select request_id, index, customer_id, m1 as message from judged where m1 is not null",
    ),
    "validate_range": with_views(
        "transactions",
        """
        select transaction_id, order_value,
               case when order_value <= 0 then 'order_value must be greater than 0'
                    else 'order_value must be less than 10000' end as message
        from (select transaction_id, order_value * 2 - 20000 as order_value from transactions)
        where order_value <= 0 or order_value > 10000
        """,
    ),
    "validate_required_fields": with_views(
        "transactions",
        """
        select transaction_id, 'Missing required field: ' || case line when '1' then 'customer_id' when '2' then 'product_id'
               when '3' then 'order_value' else 'payment_method' end as message
        from (select transaction_id, split_part(transaction_id, '-', 2) as line from transactions)
        where line in ('1', '2', '3', '4')
        """,
    ),
    "validate_optional": """
        select p_partkey, concat_ws('; ', case when p_size > 40 then 'discount_applied must be a number' end,
                                    case when p_size between 31 and 45 then 'shipping_delay_days must be a number' end) as message
        from part where p_size > 30
    """,
    "validate_numeric": """
        select p_partkey, order_value, 'order_value must be a number' as message
        from (select p_partkey, case when p_size > 25 then p_name else cast(p_retailprice as varchar) end
              as order_value from part)
        where try_cast(order_value as double) is null
    """,
    "validate_domain": with_views(
        "transactions",
        """
        select transaction_id, payment_method,
               'payment_method must be one of: 1-URGENT, 2-HIGH, 3-MEDIUM, 5-LOW' as message
        from transactions where payment_method not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
        """,
    ),
    "validate_errors": with_views(
        _REQUEST_VIEWS,
        """
        select request_id, index, cast(0 as int) as no, m1 as message from judged where m1 is not null
        union all
        select request_id, index, case when m1 is null then 0 else 1 end, m2 from judged where m2 is not null
        union all
        select request_id, index, case when m1 is null then 0 else 1 end + case when m2 is null then 0 else 1 end, m3
        from judged where m3 is not null
        """,
    ),
    "validate_batch_atomic": with_views(
        _REQUEST_VIEWS,
        """
        select request_id, 'Validation failed' as error from judged
        group by request_id having count(m1) + count(m2) + count(m3) > 0
        """,
    ),
    "validate_batch_shape": SHAPES,
    "validate_json": f"""
        select * from ({SHAPES}) where shape_error = 'Invalid JSON in request body'
    """,
    "ingest_build": with_views(_REQUEST_VIEWS, BUILT),
    "publish_keyed_json": with_views(_REQUEST_VIEWS + " built", "select customer_id as key, * from built"),
    "ingest_publish": with_views(_REQUEST_VIEWS + " built", "select customer_id as key, * from built"),
    "run_metrics": with_views(
        _REQUEST_VIEWS + " built",
        """
        select (select count(*) from events) as requests,
               (select count(*) from events) - (select count(*) from built) // 2 as rejected,
               (select count(*) from built) as sent
        """,
    ),
    "stream_decode": with_views("event_fields streamed", "select * from streamed"),
    "store_item": with_views("event_fields streamed items", "select * from items"),
    "alerts_high_value": with_views(
        "event_fields streamed",
        """
        select transaction_id, customer_id, order_value, payment_method, order_date
        from streamed where order_value > 990
        """,
    ),
    "upsert_latest": with_views("event_fields streamed items", LATEST),
    "cdc_decode": with_views("event_fields changes", f"select {ITEM_COLUMNS} from changes"),
    "cdc_filter": with_views(
        "event_fields changes", 'select event_name as "eventName", transaction_id from changes'
    ),
    "stream_upsert": with_views(
        "event_fields streamed items latest", f"select {ITEM_COLUMNS}, ingested_at from latest"
    ),
    "cdc_landing": with_views(
        "event_fields changes",
        f"select {ITEM_COLUMNS}, '2024' as year, '07' as month, '01' as day, '12' as hour from changes",
    ),
    "bulk_extract": with_views(
        "customers products behavior transactions",
        """
        select 'customers' as table_name, count(*) as rows, max(customer_id) as last_key from customers
        union all select 'products', count(*), max(product_id) from products
        union all select 'behavior', count(*), max(customer_id) from behavior
        union all select 'transactions', count(*), max(transaction_id) from transactions
        """,
    ),
    "initial_load": with_views(
        "customers products transactions dim_customer dim_product dim_payment",
        _FACT_TRANSACTIONS.format(load_type="INITIAL", **_FLOAT_FACT, **_KNOWN),
        float_transactions=f"select distinct * from ({FLOAT_TRANSACTIONS})",
    ),
    "incremental_behavior": with_views(
        "customers behavior",
        """
        select case when c.customer_id is not null then sha256(c.customer_id) end as customer_key, b.customer_id,
               cast(avg_session_time as float) as avg_session_time, pages_per_session,
               cast(cart_abandon_rate as float) as cart_abandon_rate, cast(return_rate as float) as return_rate,
               support_tickets, cast(review_score as float) as review_score, behavior_churn_signal,
               'INCREMENTAL' as load_type, '2024-07-01T12:30:00.000000' as ingested_at
        from behavior b left join customers c on b.customer_id = c.customer_id
        """,
    ),
    "incr_new_rows": with_views(
        "customers products behavior",
        """
        select 'behavior' as table_name, count(*) as rows from behavior where return_rate >= 0.2
        union all
        select 'customers', count(*) from customers where customer_id >
            (select max(b.customer_id) from behavior b join customers c on b.customer_id = c.customer_id)
        union all
        select 'products', count(*) from products
        where product_id > (select max(product_id) from products where price < 950)
        """,
    ),
    "incremental_load": with_views(
        "transactions behavior",
        _FACT_TRANSACTIONS.format(load_type="INCREMENTAL", **_FLOAT_FACT, **_ALL),
        all_customers=CUSTOMERS,
        all_products=PRODUCTS,
        customers="""
        select * from all_customers where customer_id in (select customer_id from behavior)
            or customer_id > (select max(b.customer_id) from behavior b join all_customers a
                              on a.customer_id = b.customer_id)
        """,
        products="""
        select * from all_products where price < 950
            or product_id > (select max(product_id) from all_products where price < 950)
        """,
        dim_customer=DIM_CUSTOMER,
        dim_product=DIM_PRODUCT,
        dim_payment=DIM_PAYMENT,
        float_transactions=f"select distinct * from ({FLOAT_TRANSACTIONS})",
    ),
}
ORACLES["stream_alerts"] = ORACLES["alerts_high_value"]
ORACLES["stream_publish"] = ORACLES["ingest_publish"]
ORACLES["items_compacted"] = ORACLES["stream_upsert"]
ORACLES["sink_hour_partitions"] = ORACLES["cdc_landing"]
ORACLES["stream_rejections"] = with_views(
    _REQUEST_VIEWS, f"select *, 'Validation failed' as error from ({ORACLES['validate_errors']})"
)
ORACLES["requests_to_items"] = with_views(
    _REQUEST_VIEWS,
    f"""
    select * exclude (rank) from (
        select {ITEM_COLUMNS}, '2024-07-01T12:30:00.000000' as ingested_at,
               row_number() over (partition by transaction_id order by request_id desc, index desc) as rank
        from ({BUILT.replace("select coalesce", "select request_id, index, coalesce", 1)}))
    where rank = 1
    """,
)
ORACLES["initial_line_breaks"] = with_views(
    "transactions",
    """
    select transaction_id, device_type || chr(10) || '"x", ' || chr(10) as device_type,
           cast(order_value as float) as order_value, fraud_label from transactions
    """,
)
ORACLES["extract_customers"] = with_views(
    "customers",
    """
    select * replace (cast(loyalty_score as float) as loyalty_score, cast(lifetime_value as float) as lifetime_value)
    from customers
    """,
)
ORACLES["extract_products"] = with_views(
    "products",
    """
    select * replace (cast(price as float) as price, cast(margin_percentage as float) as margin_percentage,
                      cast(popularity_score as float) as popularity_score) from products
    """,
)
ORACLES["extract_behavior"] = with_views("behavior", _FLOAT_BEHAVIOR)
ORACLES["initial_behavior"] = with_views(
    "customers behavior",
    f"""
    select c.customer_key, b.*, 'INITIAL' as load_type, '2024-07-01T12:30:00.000000' as ingested_at
    from ({_FLOAT_BEHAVIOR}) b left join
         (select customer_id, sha256(customer_id) as customer_key from customers where {_KNOWN["customer"]}) c
    on b.customer_id = c.customer_id
    """,
)
for _name, _sql in _LOADED.items():
    ORACLES[f"initial_{_name}"] = with_views(_LOADED_VIEWS, _sql.format(**_KNOWN) if "{" in _sql else _sql)
    ORACLES[f"incremental_{_name}"] = with_views(_LOADED_VIEWS, _sql.format(**_LATER) if "{" in _sql else _sql)

ORACLES["stream_upsert_folded"] = ORACLES["stream_upsert"]
ORACLES["kafka_to_items"] = ORACLES["stream_upsert"]
ORACLES["stream_replay"] = with_views(
    "event_fields streamed",
    """
    select 'item' as kind, transaction_id, cast(order_value as double) as order_value from streamed
    union all
    select 'alert', transaction_id, cast(order_value as double) from streamed where order_value > 990
    """,
)
ORACLES["stream_empty_batch"] = with_views(
    "event_fields streamed " + _REQUEST_VIEWS.replace("event_fields ", "") + " built",
    """
    select 'log' as folder, cast(1 as bigint) as batch_id, count(*) as rows from streamed
    union all select 'alerts', 1, count(*) from streamed where order_value > 990
    union all select 'out/messages', 1, count(*) from built
    union all select 'out/rejections', 1, (select count(*) from events) - (select count(*) from built) // 2
    """,
)
ORACLES["cdc_other_tags"] = with_views(
    "event_fields",
    """
    select concat('E', cast(event_id as varchar)) as transaction_id,
           case event_id % 10
               when 0 then '{"L":[{"S":"' || payment_method || '"},{"N":"' || ts_day || '"}]}'
               when 1 then '{"M":{"a":{"S":"' || ts_day || '"}}}'
               when 2 then '{"SS":["a","b c"]}'
               when 3 then '{"NS":["' || ts_day || '","2"]}'
               when 4 then '{"B":"aGk="}'
               when 5 then 'false'
               when 6 then cast(ts_day as varchar)
               when 7 then ts_day || '.5'
               when 8 then payment_method end as device_type,
           cast(case event_id % 3 when 0 then ts_day when 1 then 7 end as int) as shipping_delay_days
    from event_fields
    """,
)
ORACLES["incr_watermark_marked"] = ORACLES["incr_watermark_products"]
ORACLES["cdc_two_hours"] = with_views(
    "event_fields changes",
    f"""
    select {ITEM_COLUMNS}, '2024' as year, '07' as month, '01' as day,
           case when right(transaction_id, 1) in ('0', '2', '4', '6', '8') then '12' else '13' end as hour
    from changes
    """,
)
ORACLES["clean_drops"] = with_views(
    "customers products behavior transactions",
    """
    select 'products' as table_name, count(*) filter (n % 7 <> 0 and n % 5 <> 0) as kept,
           coalesce(cast(sum(copies) filter (n % 7 = 0) as bigint), 0) as malformed,
           coalesce(cast(sum(copies) filter (n % 7 <> 0 and n % 5 = 0) as bigint), 0) as nulls,
           coalesce(cast(sum(copies - 1) filter (n % 7 <> 0 and n % 5 <> 0) as bigint), 0) as repeated
    from (select n, 1 + case when n % 3 = 0 then 1 else 0 end + case when n % 4 = 0 then 1 else 0 end as copies
          from (select cast(product_id as int) as n from products))
    union all select 'customers', count(*), 0, 0, 0 from customers
    union all select 'behavior', count(*), 0, 0, 0 from behavior
    union all select 'transactions', (select count(*) from (select distinct * from transactions)), 0, 0,
                     count(*) - (select count(*) from (select distinct * from transactions)) from transactions
    """,
)
