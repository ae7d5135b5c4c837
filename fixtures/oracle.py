"""The SQL each query is checked against, over the given tables alone."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Texts and options that the views must show, written out here again.
# ---------------------------------------------------------------------------

HIGH_RISK_ADVICE = (
    "This shipping mode has very high late delivery risk. It should be reviewed immediately and"
    " avoided for sensitive orders unless the process is improved."
)
MEDIUM_RISK_ADVICE = (
    "This shipping mode has medium-to-high delivery risk. It should be monitored carefully and "
    "compared with safer alternatives."
)
LOW_RISK_ADVICE = (
    "This shipping mode has relatively lower delivery risk and can be used under regular "
    "monitoring."
)
MARKET_ADVICE = (
    "Recommended decision: review logistics planning, supplier coordination, and shipping "
    "performance in this market, especially if it also has high order volume."
)
LATE_ADVICE = (
    "Recommended decision: prioritize this order, monitor it closely, or consider switching to a "
    "safer and faster shipping mode."
)
ON_TIME_ADVICE = (
    "Recommended decision: continue with the regular order workflow while maintaining standard operational monitoring."
)
FIXED_OPTIONS = {
    "type": ["DEBIT", "TRANSFER", "CASH", "PAYMENT"],
    "customer_segment": ["Consumer", "Corporate", "Home Office"],
    "department_name": ["Fitness", "Fan Shop", "Apparel", "Golf", "Footwear", "Outdoors", "Technology"],
    "order_country": ["United States", "India", "Australia", "Indonesia", "Mexico", "France", "Germany", "Brazil"],
    "order_state": ["California", "New York", "Texas", "Queensland", "Java Occidental", "Rajastán", "England", "Ile-de-France"],
}

# ---------------------------------------------------------------------------

# --- order lines ---------------------------------------------------------------------------

WIDE = """
wide as (
  select t.*,
    case when days_for_shipping_real > days_for_shipment_scheduled then 1 else 0 end as late_delivery_risk,
    case when days_for_shipping_real > days_for_shipment_scheduled then 'Late delivery'
         when days_for_shipping_real = days_for_shipment_scheduled then 'Shipping on time'
         else 'Advance shipping' end as delivery_status
  from (
    select l.l_orderkey as order_id, o.o_orderpriority as shipping_mode, l.l_returnflag as type,
      p.p_name as product_name, p.p_brand as category_name, p.p_type as department_name,
      c.c_mktsegment as customer_segment, r.r_name as market,
      concat(r.r_name, '-', cast((n.n_nationkey // 5) % 3 as varchar)) as order_region,
      n.n_name as order_country, concat('S', cast(c.c_custkey % 50 as varchar)) as order_state,
      o.o_orderdate as order_date, l.l_shipdate as shipping_date,
      cast(((date_diff('day', o.o_orderdate, l.l_shipdate) % 10) + 10) % 10 as integer) as days_for_shipping_real,
      case o.o_orderpriority when '1-URGENT' then 2 when '2-HIGH' then 4 when '3-MEDIUM' then 6
           when '4-NOT SPECIFIED' then 7 else 8 end as days_for_shipment_scheduled,
      l.l_quantity as order_item_quantity, l.l_extendedprice as sales,
      2 * l.l_discount as order_item_discount_rate,
      l.l_extendedprice * 2 * l.l_discount as order_item_discount,
      p.p_retailprice as order_item_product_price, p.p_retailprice as product_price,
      l.l_extendedprice * (1 - 2 * l.l_discount)
        - cast(0.8 as double) * l.l_quantity * p.p_retailprice as order_profit_per_order
    from lineitem l
    join orders o on l.l_orderkey = o.o_orderkey
    join customer c on o.o_custkey = c.c_custkey
    join nation n on c.c_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
    join part p on l.l_partkey = p.p_partkey
  ) t
)"""


def features(source: str) -> str:
    """The derived columns over a source of order lines."""
    return f"""
select *, days_for_shipping_real - days_for_shipment_scheduled as shipping_delay_days,
  case when sales <> 0 then order_profit_per_order / sales end as profit_margin,
  case when order_profit_per_order < 0 then 1 else 0 end as is_loss_order,
  case when order_item_discount_rate is null then 'Unknown'
       when order_item_discount_rate = 0 then 'No Discount'
       when order_item_discount_rate <= 0.05 then 'Low'
       when order_item_discount_rate <= 0.15 then 'Medium' else 'High' end as discount_level
from {source}"""


LINES = f"{WIDE}, lines as ({features('wide')})"

# --- gold ----------------------------------------------------------------------------------

_ORDERS = "count(distinct order_id)"
_LATE = "count(distinct case when late_delivery_risk = 1 then order_id end)"
_LOSS = "count(distinct case when is_loss_order = 1 then order_id end)"


def _rate(part: str) -> str:
    return f"case when {_ORDERS} > 0 then cast({part} as double) / {_ORDERS} * 100 else cast(0 as double) end"


def _money(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(18,4))) as double)"


FIGURES = {
    "total_orders": _ORDERS,
    "late_orders": _LATE,
    "loss_orders": _LOSS,
    "late_delivery_rate": _rate(_LATE),
    "loss_rate": _rate(_LOSS),
    "total_sales": _money("sales"),
    "total_profit": _money("order_profit_per_order"),
    "average_profit_per_order": f"{_money('order_profit_per_order')} / count(order_profit_per_order)",
    "average_shipping_days": "cast(sum(days_for_shipping_real) as double) / count(days_for_shipping_real)",
    "average_profit_margin": "round(avg(profit_margin) * 100, 4)",
    "average_discount_rate": f"{_money('order_item_discount_rate')} / count(order_item_discount_rate) * 100",
}

_LATE_FIGURES = "total_orders late_orders late_delivery_rate average_shipping_days total_sales total_profit".split()
_PRODUCT = ["product_name", "category_name"]
_PRODUCT_FIGURES = "total_orders total_sales total_profit late_orders late_delivery_rate".split()
_BY_RATE = "late_delivery_rate desc nulls last"

GOLD = {
    "executive_kpis": (
        [],
        "total_orders total_sales total_profit late_delivery_rate average_shipping_days average_profit_margin".split(),
        "",
    ),
    "late_by_shipping_mode": (["shipping_mode"], _LATE_FIGURES, ""),
    "late_by_market": (["market"], _LATE_FIGURES, ""),
    "late_by_region": (["order_region"], _LATE_FIGURES, ""),
    "late_by_category": (["category_name"], _LATE_FIGURES, ""),
    "late_by_segment": (["customer_segment"], _LATE_FIGURES, ""),
    "late_by_country": (["order_country"], _LATE_FIGURES, f"order by {_BY_RATE}, order_country limit 20"),
    "profit_impact": (
        ["delivery_status"],
        "total_orders total_sales total_profit average_profit_per_order average_profit_margin loss_orders loss_rate".split(),
        "",
    ),
    "risky_products": (
        _PRODUCT,
        _PRODUCT_FIGURES,
        f"having count(distinct order_id) >= 20 "
        f"order by {_BY_RATE}, total_sales desc nulls last, product_name, category_name limit 25",
    ),
    "discount_profit_summary": (
        ["discount_level"],
        "total_orders average_discount_rate total_sales total_profit average_profit_margin loss_orders loss_rate".split(),
        "",
    ),
    "top_products_by_sales": (
        _PRODUCT,
        _PRODUCT_FIGURES,
        "order by total_sales desc nulls last, product_name, category_name limit 25",
    ),
    "loss_by_market": (["market"], "total_orders loss_orders loss_rate total_sales total_profit".split(), ""),
    "profit_margin_by_category": (
        ["category_name"],
        "total_orders total_sales total_profit average_profit_margin".split(),
        "order by avg(profit_margin) desc nulls last, category_name limit 20",
    ),
}


def gold_select(name: str) -> str:
    keys, figures, tail = GOLD[name]
    columns = ", ".join(keys + [f"{FIGURES[f]} as {f}" for f in figures])
    group = f"group by {', '.join(keys)}" if keys else ""
    return f"select {columns} from lines {group} {tail}"


def gold(name: str) -> str:
    return f"with {LINES} {gold_select(name)}"


def view(name: str, select: str) -> str:
    """A select over one gold table, called ``g``."""
    return f"with {LINES}, g as ({gold_select(name)}) {select}"


def _groups() -> str:
    all_keys = [
        "shipping_mode", "market", "order_region", "category_name", "order_country", "delivery_status",
        "product_name", "discount_level",
    ]
    parts = []
    for keys in [[], *[[k] for k in all_keys if k != "product_name"], _PRODUCT]:
        name = "+".join(keys) or "all"
        columns = [f"{key if key in keys else 'cast(null as varchar)'} as {key}" for key in all_keys]
        columns += [f"{sql} as {figure}" for figure, sql in FIGURES.items()]
        group = f"group by {', '.join(keys)}" if keys else ""
        parts.append(f"select '{name}' as key_set, {', '.join(columns)} from lines {group}")
    return f"with {LINES} " + " union all ".join(parts)


def _listing() -> str:
    names = [name for name in GOLD if name != "late_by_segment"]
    ctes = ", ".join(f"g_{name} as ({gold_select(name)})" for name in names)
    return f"with {LINES}, {ctes} " + " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, cast({len(GOLD[name][0] + GOLD[name][1])} as integer) as column_count, "
        f"'{','.join(GOLD[name][0] + GOLD[name][1])}' as column_names from g_{name}"
        for name in names
    )


def _key_checks() -> str:
    ctes, parts = [], []
    for name, (keys, _, _) in GOLD.items():
        if name == "late_by_segment":
            continue
        ctes.append(f"g_{name} as ({gold_select(name)})")
        nulls = " or ".join(f"{key} is null" for key in keys) or "false"
        group = f"group by {', '.join(keys)}" if keys else ""
        parts.append(
            f"""select '{name}' as table_name, (select count(*) from g_{name}) as row_count,
            (select count(*) from (select count(*) as n from g_{name} {group}) where n > 1) as repeated_keys,
            (select count(*) from g_{name} where {nulls}) as null_keys"""
        )
    return f"with {LINES}, {', '.join(ctes)} " + " union all ".join(parts)


# --- raw file ------------------------------------------------------------------------------

_DEC = "cast(cast({} as decimal(18,4)) as varchar)"
_DAY = "strftime({}, '%-m/%-d/%Y %-H:%M')"

RAW_COLUMNS = {
    "Type": "type",
    "Days for shipping (real)": "cast(days_for_shipping_real as varchar)",
    "Days for shipment (scheduled)": "cast(days_for_shipment_scheduled as varchar)",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "cast(late_delivery_risk as varchar)",
    "Category Name": "'  ' || category_name || ' '",
    "Customer Segment": "case when customer_segment = 'MACHINERY' then '   ' "
    "when customer_segment <> 'HOUSEHOLD' then customer_segment || '  ' end",
    "Department Name": "department_name",
    "Market": "market || ' '",
    "Order Country": "order_country",
    "order date (DateOrders)": f"case when type = 'N' then strftime(order_date, '%Y-%m-%d') "
    f"else {_DAY.format('order_date')} end",
    "Order Id": "cast(order_id as varchar)",
    "Order Item Discount": f"'$' || {_DEC.format('order_item_discount')}",
    "Order Item Discount Rate": "case when order_item_quantity = 7 then 'n/a' "
    "else cast(cast(order_item_discount_rate as decimal(5,2)) as varchar) end",
    "Order Item Quantity": "cast(order_item_quantity as varchar)",
    "Sales": "' $' || format('{:,.2f}', sales)",
    "Order Profit Per Order": _DEC.format("order_profit_per_order"),
    "Order Region": "order_region",
    "Order State": "order_state",
    "Product Name": "product_name",
    "Product Price": f"case when order_item_quantity = 11 then '-' else {_DEC.format('product_price')} end",
    "shipping date (DateOrders)": _DAY.format("shipping_date"),
    "Shipping Mode": "shipping_mode",
}
CLEAN_NAMES = {
    "Type": "type",
    "Days for shipping (real)": "days_for_shipping_real",
    "Days for shipment (scheduled)": "days_for_shipment_scheduled",
    "Delivery Status": "delivery_status",
    "Late_delivery_risk": "late_delivery_risk",
    "Category Name": "category_name",
    "Customer Segment": "customer_segment",
    "Department Name": "department_name",
    "Market": "market",
    "Order Country": "order_country",
    "order date (DateOrders)": "order_date",
    "Order Id": "order_id",
    "Order Item Discount": "order_item_discount",
    "Order Item Discount Rate": "order_item_discount_rate",
    "Order Item Quantity": "order_item_quantity",
    "Sales": "sales",
    "Order Profit Per Order": "order_profit_per_order",
    "Order Region": "order_region",
    "Order State": "order_state",
    "Product Name": "product_name",
    "Product Price": "product_price",
    "shipping date (DateOrders)": "shipping_date",
    "Shipping Mode": "shipping_mode",
}
_TIMES = ["order_date", "shipping_date"]
_TEXTS = (
    "type delivery_status category_name customer_segment department_name market order_country "
    "order_region order_state product_name shipping_mode"
).split()


def _selected(names: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{names.get(raw, raw)}"' for raw, sql in RAW_COLUMNS.items())


def _cleaned(name: str) -> str:
    if name in _TIMES:
        return f"try_strptime({name}, '%-m/%-d/%Y %-H:%M') as {name}"
    if name in _TEXTS:
        return f"coalesce(nullif(trim({name}), ''), 'Unknown') as {name}"
    return f"try_cast(regexp_replace(trim({name}), '[^0-9.\\-]', '', 'g') as double) as {name}"


RAW = f"{WIDE}, raw as (select {_selected(CLEAN_NAMES)} from wide)"
STANDARD = f"{RAW}, standard as (select {', '.join(_cleaned(n) for n in CLEAN_NAMES.values())} from raw)"
TWICE = (
    f"{STANDARD}, twice as (select * from standard union all select * from standard where type = 'R'), "
    "single as (select distinct * from twice)"
)
_ROW_TEXT = " || ".join(f"coalesce(length({name}) || ':' || {name}, '-')" for name in CLEAN_NAMES.values())
_CHECKED = (
    "order_date shipping_date sales order_profit_per_order late_delivery_risk shipping_mode market "
    "order_region category_name"
).split()
_LEVEL = (
    "case when sales is null then 'Unknown' when sales <= (select quantile_disc(sales, 0.33) from {0}) then 'Low' "
    "when sales <= (select quantile_disc(sales, 0.66) from {0}) then 'Medium' else 'High' end as sales_level"
)
_DATE_PARTS = (
    "cast(year(order_date) as integer) as order_year, cast(month(order_date) as integer) as order_month, "
    "cast(dayofweek(order_date) + 1 as integer) as order_day_of_week"
)

# --- models --------------------------------------------------------------------------------

_NUMBERS = (
    "days_for_shipment_scheduled order_item_quantity order_item_discount order_item_discount_rate "
    "order_item_product_price product_price sales"
).split()
_LEVELLED = (
    "type category_name customer_segment department_name market order_region order_country order_state shipping_mode"
).split()
_SCORED = f"""{WIDE}, scored as (
  select late_delivery_risk as label,
    (9 - days_for_shipment_scheduled) / cast(10 as double) + sales / cast(10000000 as double) as score from wide),
predicted as (select *, case when score >= 0.5 then 1 else 0 end as prediction from scored)"""
_CELLS = """, cells as (select
  cast(count(*) filter (label = 0 and prediction = 0) as double) as n00,
  cast(count(*) filter (label = 0 and prediction = 1) as double) as n01,
  cast(count(*) filter (label = 1 and prediction = 0) as double) as n10,
  cast(count(*) filter (label = 1 and prediction = 1) as double) as n11 from predicted)"""
_CLASS_FIGURES = """, figures as (
  select '0' as class, coalesce(n00 / nullif(n00 + n10, 0), 0) as p, coalesce(n00 / nullif(n00 + n01, 0), 0) as r,
    coalesce(2 * n00 / nullif(2 * n00 + n01 + n10, 0), 0) as f, n00 + n01 as s from cells
  union all
  select '1', coalesce(n11 / nullif(n11 + n01, 0), 0), coalesce(n11 / nullif(n11 + n10, 0), 0),
    coalesce(2 * n11 / nullif(2 * n11 + n01 + n10, 0), 0), n10 + n11 from cells)"""
_ROC = f"""{_SCORED}, by_score as (
  select score as threshold, count(*) filter (label = 1) as positives, count(*) filter (label = 0) as negatives
  from predicted group by score),
ranked as (select *, sum(positives) over w as tp, sum(negatives) over w as fp,
  sum(positives) over () as p, sum(negatives) over () as n
  from by_score window w as (order by threshold desc rows unbounded preceding))"""


def _union(parts) -> str:
    return " union all ".join(parts)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _tier(high: str, medium: str, low: str) -> str:
    return (
        f"case when late_delivery_rate >= 70 then {_text(high)} when late_delivery_rate >= 50 then {_text(medium)} "
        f"else {_text(low)} end"
    )


def _human(column: str) -> str:
    return f"""case when {column} is null then '0'
      when abs({column}) >= 1000000 then format('{{:.2f}}M', cast({column} as double) / 1000000)
      when abs({column}) >= 1000 then format('{{:.2f}}K', cast({column} as double) / 1000)
      when {column} = floor({column}) then cast(cast({column} as bigint) as varchar)
      else format('{{:.2f}}', cast({column} as double)) end"""


def _half_up(value: str) -> str:
    """Two decimals, rounded half up on the shortest decimal form."""
    return f"cast(cast(round(cast(cast({value} as varchar) as decimal(38,18)), 2) as decimal(18,2)) as varchar) || '%'"


_RATE_TEXT = f"{_half_up('late_delivery_rate')} as rate_text"


def _choice(late: str, on_time: str) -> str:
    return f"case when prediction = 1 then {_text(late)} else {_text(on_time)} end"


_RULES = f"""{WIDE}, scored as (
  select 0 as place, 'schedule' as model, late_delivery_risk as label,
    (9 - days_for_shipment_scheduled) / cast(10 as double) + sales / cast(10000000 as double) as score from wide
  union all select 1, 'quantity', late_delivery_risk, order_item_quantity / cast(50 as double) from wide),
cells as (
  select place, model, cast(count(*) as double) as n,
    cast(count(*) filter (label = 1 and score >= 0.5) as double) as hit,
    cast(count(*) filter (score >= 0.5) as double) as flagged, cast(sum(label) as double) as late,
    cast(count(*) filter ((score >= 0.5) = (label = 1)) as double) as agreed
  from scored group by all),
by_score as (
  select model, score, cast(sum(label) as double) as p, cast(sum(1 - label) as double) as q from scored group by all),
ranked as (select *, coalesce(sum(p) over (
  partition by model order by score desc rows between unbounded preceding and 1 preceding), 0) as above from by_score),
areas as (select model, sum(q * (above + p / 2)) / (sum(p) * sum(q)) as area from ranked group by model),
figures as (select *, 2 * hit / (flagged + late) as f1 from cells join areas using (model))"""

_SLOT_NAMES = "numbered as (" + " union all ".join(
    [f"select {i} as place, '' as level, 'num__{c}' as feature" for i, c in enumerate(_NUMBERS)]
    + [f"select distinct {len(_NUMBERS) + i}, {c}, 'cat__{c}_' || {c} from wide" for i, c in enumerate(_LEVELLED)]
) + "), slots as (select *, cast(row_number() over (order by place, level) - 1 as integer) as slot from numbered)"


def _tree(depth: int, bins: int) -> str:
    """CTEs that grow one tree over all rows and slots, level by level; ``nodes`` has its nodes, ``ends`` the leaf of each row."""
    shares = f"[{', '.join(str(k / bins) for k in range(1, bins))}]"
    edges = " union all ".join(
        f"select {i} as slot, unnest(list_distinct(quantile_disc({c}, {shares}))) as edge, max({c}) as top from wide"
        for i, c in enumerate(_NUMBERS)
    )
    codes = " union all ".join(
        [
            f"select r, {i} as slot, (select count(*) from edges e where e.slot = {i} and e.edge < x) as code "
            f"from (select r, {c} as x from placed)"
            for i, c in enumerate(_NUMBERS)
        ]
        + [
            f"select r, slot, 1 from placed join slots on place = {len(_NUMBERS) + i} and level = {c}"
            for i, c in enumerate(_LEVELLED)
        ]
    )
    parts = [
        f"""{WIDE}, {_SLOT_NAMES},
        placed as materialized (select *, row_number() over () as r, late_delivery_risk as y from wide),
        weights as (select max(case when y = 0 then w end) as w0, max(case when y = 1 then w end) as w1 from (
          select y, cast((select count(*) from placed) as double) / (2 * count(*)) as w from placed group by y)),
        edges as (select slot, edge from ({edges}) where edge < top),
        codes as materialized ({codes}),
        at_0 as (select r, y, 1 as node from placed)"""
    ]
    purity = "({a} * {a} + {b} * {b}) / ({a} + {b})"
    for level in range(depth):
        parts.append(f"""
        all_{level} as (select node, sum(1 - y) as n0, sum(y) as n1 from at_{level} group by node),
        hist_{level} as (select node, slot, code, sum(1 - y) as c0, sum(y) as c1
          from at_{level} join codes using (r) group by all),
        cuts_{level} as (
          select node, slot, code as cut, sum(c0) over upto as l0, sum(c1) over upto as l1 from hist_{level}
          where slot < {len(_NUMBERS)} window upto as (partition by node, slot order by code)
          union all select node, slot, 0, n0 - c0, n1 - c1 from hist_{level} join all_{level} using (node)
          where slot >= {len(_NUMBERS)}),
        sides_{level} as (select node, slot, cut, n0 * w0 as a0, n1 * w1 as a1, l0 * w0 as l0, l1 * w1 as l1,
            (n0 - l0) * w0 as r0, (n1 - l1) * w1 as r1
          from cuts_{level} join all_{level} using (node), weights
          where n0 > 0 and n1 > 0 and l0 + l1 > 0 and l0 + l1 < n0 + n1),
        splits_{level} as (
          select node, slot, cut, score - {purity.format(a="a0", b="a1")} as gain
          from (select *, {purity.format(a="l0", b="l1")} + {purity.format(a="r0", b="r1")} as score from sides_{level})
          qualify row_number() over (partition by node order by score desc, slot, cut) = 1),
        at_{level + 1} as (
          select r, y, 2 * node + case when coalesce(c.code, 0) > cut then 1 else 0 end as node
          from at_{level} join splits_{level} s using (node) left join codes c using (r, slot))""")
    last = f"select node, sum(1 - y) as n0, sum(y) as n1, null as slot, null as cut, null as gain from at_{depth} group by node"
    inner = [
        f"select node, n0, n1, slot, cut, gain from all_{i} left join splits_{i} using (node)" for i in range(depth)
    ]
    parts.append(f"""
        nodes as (select cast(node as integer) as node, cast(coalesce(slot, -1) as integer) as slot,
            cast(coalesce(cut, 0) as integer) as cut, n0 * w0 as weight_0, n1 * w1 as weight_1, coalesce(gain, 0) as gain
          from ({" union all ".join([*inner, last])}), weights),
        ends as (select r, node from nodes join ({" union all ".join(f"select r, node from at_{i}" for i in range(depth + 1))})
          using (node) where slot = -1)""")
    return "with " + ",".join(parts)


_TREE = _tree(4, 8)

_TABLES = ["lineitem", "orders", "customer", "part", "nation", "region"]

ORACLE = {
    **{name: gold(name) for name in GOLD},
    "gold_groups": _groups(),
    "gold_groups_clustered": _groups(),
    "gold_key_violations": _key_checks(),
    "most_risky_mode": view(
        "late_by_shipping_mode", f"select shipping_mode from g order by {_BY_RATE}, shipping_mode limit 1"
    ),
    "top_categories_by_sales": view(
        "late_by_category", "select * from g order by total_sales desc, category_name limit 10"
    ),
    "top12_categories_by_sales": view(
        "late_by_category", "select * from g order by total_sales desc, category_name limit 12"
    ),
    "market_order_share": view(
        "late_by_market",
        "select market, total_orders, total_orders / (select cast(sum(total_orders) as double) from g) * 100 "
        "as order_share from g",
    ),
    "top_regions_by_risk": view("late_by_region", f"select * from g order by {_BY_RATE}, order_region limit 12"),
    "top_countries_by_risk": view("late_by_country", f"select * from g order by {_BY_RATE}, order_country limit 12"),
    "top_categories_by_risk": view("late_by_category", f"select * from g order by {_BY_RATE}, category_name limit 12"),
    "top12_products_by_sales": view(
        "top_products_by_sales", "select * from g order by total_sales desc, product_name, category_name limit 12"
    ),
    "top12_risky_products": view(
        "risky_products",
        f"select * from g order by {_BY_RATE}, total_sales desc, product_name, category_name limit 12",
    ),
    "shipping_mode_decisions": view(
        "late_by_shipping_mode",
        "select shipping_mode, late_delivery_rate, total_orders, late_orders, "
        f"{_RATE_TEXT}, {_tier('danger', 'warning', 'success')} as level, "
        f"{_tier(HIGH_RISK_ADVICE, MEDIUM_RISK_ADVICE, LOW_RISK_ADVICE)} as decision from g",
    ),
    "market_decisions": view(
        "late_by_market",
        f"select market, late_delivery_rate, total_orders, late_orders, {_RATE_TEXT}, 'info' as level, "
        f"{_text(MARKET_ADVICE)} as decision from g",
    ),
    "kpi_display": view(
        "executive_kpis",
        _union(
            [
                *[
                    f"select '{title}' as metric, {_human(column)} as display_value from g"
                    for title, column in [
                        ("Total Orders", "total_orders"),
                        ("Total Sales", "total_sales"),
                        ("Total Profit", "total_profit"),
                    ]
                ],
                "select 'Late Delivery Rate', format('{:.2f}%', late_delivery_rate) from g",
                "select 'Avg Shipping Days', format('{:.2f}', average_shipping_days) from g",
            ]
        ),
    ),
    "prediction_options": f"with {WIDE} "
    + _union(
        [
            f"select distinct '{c}' as field, {c} as option_value from wide where {c} is not null"
            for c in ["shipping_mode", "market", "order_region", "category_name"]
        ]
        + [f"select '{field}', {_text(value)}" for field, values in FIXED_OPTIONS.items() for value in values]
    ),
    "ingest_profile": _union(
        f"select '{t}' as table_name, (select count(*) from {t}) as row_count, cast(count(*) as integer) "
        f"as column_count, string_agg(column_name, ',') as column_names from (describe {t})"
        for t in _TABLES
    ),
    "ingest_digest": f"with {RAW} select count(*) as row_count, "
    f"cast(sum(cast('0x' || substr(md5({_ROW_TEXT}), 1, 15) as bigint)) as varchar) as content from raw",
    "file_choices": """with c as (select count(*) as n from customer)
      select 'one' as folder, 'one' as rule, 'utf-8' as encoding, n as lines, n as read_right from c
      union all select 'two', 'several', null, null, null
      union all select 'two', 'named', 'ISO-8859-1', n, n from c
      union all select 'none', 'none', null, null, null""",
    "unique_columns": "select c_custkey as c_key, c_nationkey as c_key_2, c_name as c_key_3, c_mktsegment as c_key_1 "
    "from customer",
    "privacy_drop": f"with {WIDE} select {_selected({})} from wide",
    "rename_columns": f"with {RAW} select * from raw",
    "clean_categorical": f"with {STANDARD} select order_raw.order_id, category_name, customer_segment, market, type, "
    "shipping_mode, delivery_status from (select * replace (cast(cast(order_id as bigint) as varchar) as order_id) "
    "from standard) order_raw",
    "clean_numeric": f"with {STANDARD} select order_id, days_for_shipping_real, late_delivery_risk, order_item_discount, "
    "order_item_discount_rate, order_item_quantity, order_profit_per_order, product_price, sales from standard",
    "parse_timestamps": f"with {STANDARD} select cast(cast(order_id as bigint) as varchar) as order_id, order_date, "
    "shipping_date from standard",
    "dedup_rows": "select distinct * from (select * from lineitem union all select * from lineitem where l_returnflag = 'R')",
    "dedup_rows_by_hash": "select distinct * from "
    "(select * from lineitem union all select * from lineitem where l_returnflag = 'R')",
    "clean_report": f"with {TWICE} select (select count(*) from twice) as rows_before, count(*) as rows_after, "
    "(select count(*) from twice) - count(*) as duplicates_removed, "
    + ", ".join(f"count(*) filter ({c} is null) as {c}_nulls" for c in _CHECKED)
    + " from single",
    "null_summary": f"with {STANDARD} "
    + _union(f"select '{c}' as column_name, count(*) filter ({c} is null) as null_count from standard" for c in _CHECKED),
    "clean_orders": f"with {TWICE}, featured as ({features('single')}) "
    f"select * replace (round(profit_margin, 6) as profit_margin), {_LEVEL.format('single')}, {_DATE_PARTS} from featured",
    "line_features": f"with {LINES} select order_id, round(order_profit_per_order, 4) as order_profit_per_order, "
    "shipping_delay_days, round(profit_margin, 6) as profit_margin, is_loss_order, discount_level from lines",
    "date_parts": f"with {WIDE} select order_id, {_DATE_PARTS} from wide",
    "sales_thresholds": f"with {WIDE} select quantile_disc(sales, 0.33) as low_sales_threshold, "
    "quantile_disc(sales, 0.66) as high_sales_threshold from wide",
    "sales_level": f"with {WIDE} select order_id, sales, {_LEVEL.format('wide')} from wide",
    "ml_imputed_levels": f"with {WIDE} select coalesce(nullif(type, 'R'), 'Unknown') as level, count(*) as lines "
    "from wide group by 1",
    "ml_class_distribution": f"with {WIDE} select late_delivery_risk, count(*) as rows from wide group by 1",
    "ml_class_weights": f"with {WIDE} select late_delivery_risk, count(*) as rows, "
    "cast((select count(*) from wide) as double) / ((select count(distinct late_delivery_risk) from wide) * count(*)) "
    "as class_weight from wide group by 1",
    "ml_split_counts": f"""with {WIDE}, counts as (
        select late_delivery_risk, count(*) as n, (select count(*) from wide) as total from wide group by 1),
      shares as (select *, (total + 4) // 5 as wanted from counts),
      floors as (select *, wanted * n // total as base, wanted * n % total as remainder from shares),
      ranked as (select *, row_number() over (order by remainder desc, late_delivery_risk) as place,
        wanted - sum(base) over () as left_over from floors),
      tests as (select late_delivery_risk, n, cast(base + case when place <= left_over then 1 else 0 end as bigint) as held
        from ranked)
      select 'test' as part, late_delivery_risk, held as rows from tests
      union all select 'train', late_delivery_risk, n - held from tests""",
    "ml_numeric_medians": f"with {WIDE} "
    + _union(f"select '{c}' as feature, round(cast(median({c}) as double), 4) as median from wide" for c in _NUMBERS),
    "ml_scaled_stats": f"with {WIDE} "
    + _union(
        f"select '{c}' as feature, round(cast(median({c}) as double), 4) as median, round(avg({c}), 4) as mean, "
        f"round(stddev_pop({c}), 4) as deviation, round((min({c}) - avg({c})) / stddev_pop({c}), 4) as smallest, "
        f"round((max({c}) - avg({c})) / stddev_pop({c}), 4) as largest from wide"
        for c in _NUMBERS
    ),
    "ml_onehot_levels": f"with {WIDE} "
    + _union(
        f"select '{c}' as feature, {c} as level, cast(row_number() over (order by {c}) - 1 as integer) as slot "
        f"from (select distinct {c} from wide)"
        for c in _LEVELLED
    ),
    "rule_comparison": f"""with {_RULES} select place, model, round(agreed / n, 4) as accuracy,
        round(hit / flagged, 4) as precision, round(hit / late, 4) as recall, round(f1, 4) as f1_score,
        round(area, 4) as roc_auc, f1 = (select max(f1) from figures) as is_best from figures""",
    "score_advice": f"""with {WIDE}, scored as (select order_id,
        (9 - days_for_shipment_scheduled) / cast(10 as double) + sales / cast(10000000 as double) as score from wide),
      predicted as (select *, case when score >= 0.5 then 1 else 0 end as prediction from scored)
      select order_id, prediction, {_choice("High Late Delivery Risk", "Low Late Delivery Risk")} as title,
        {_choice("danger", "success")} as level, {_choice(LATE_ADVICE, ON_TIME_ADVICE)} as advice,
        'Predicted late-risk probability: ' || {_half_up("score * 100")} as probability_text from predicted""",
    "forest_nodes": f"""{_TREE} select cast(tree as integer) as tree, node, slot, cut, round(weight_0, 4) as weight_0,
        round(weight_1, 4) as weight_1, round(gain, 4) as gain from nodes, range(2) t(tree)""",
    "forest_scores": f"""{_TREE} select order_id, cast(weight_1 / (weight_0 + weight_1) > 0.5 as integer) as prediction,
        round(weight_1 / (weight_0 + weight_1), 8) as late_probability
        from placed join ends using (r) join nodes using (node)""",
    "forest_importances": f"""{_TREE} select feature, round(sum(gain) / (select sum(gain) from nodes), 8) as importance
        from nodes join slots using (slot) group by feature having sum(gain) > 0""",
    "ml_regression_gradient": f"""with {WIDE}, {_SLOT_NAMES} select feature, cast(0 as double) as gradient from slots
        union all select 'intercept', 0""",
    "model_reloaded": f"with {WIDE} select count(*) as rows, cast(0 as bigint) as changed from wide",
    "confusion_matrix": f"with {_SCORED} "
    + _union(
        f"select {a} as actual, {p} as predicted, count(*) filter (label = {a} and prediction = {p}) as rows from predicted"
        for a in (0, 1)
        for p in (0, 1)
    ),
    "classification_report": f"""with {_SCORED} {_CELLS} {_CLASS_FIGURES}
      select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score,
        cast(s as bigint) as support from figures
      union all select 'accuracy', null, null, round((n00 + n11) / (n00 + n01 + n10 + n11), 6),
        cast(n00 + n01 + n10 + n11 as bigint) from cells
      union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(s) as bigint) from figures
      union all select 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
        round(sum(f * s) / sum(s), 6), cast(sum(s) as bigint) from figures""",
    "roc_curve": f"with {_ROC} select threshold, cast(fp as double) / n as fpr, cast(tp as double) / p as tpr from ranked "
    "union all select null, cast(0 as double), cast(0 as double)",
    "roc_auc": f"with {_ROC} select round(sum(negatives * (cast(tp - positives as double) + positives / 2)) "
    "/ (cast(max(p) as double) * max(n)), 10) as roc_auc from ranked",
}

_PERSONAL = 9  # personal columns of the raw file
_KEPT = len(RAW_COLUMNS)
_DERIVED = 8  # delay, margin, loss, two levels, three parts of a date

ORACLE |= {
    **{f"job_{name}": gold(name) for name in GOLD if name != "late_by_segment"},
    "job_clean_orders": "select * replace (order_state || '\u00e9' as order_state) from "
    f"({ORACLE['clean_orders']})",
    "job_reports": f"""with {TWICE}, sizes as (
        select (select count(*) from twice) as before, (select count(*) from single) as after)
      select 'ingest' as job, 'success' as status, before as rows_before, before as rows_after,
        {_KEPT + _PERSONAL} as column_count_before, {_KEPT + _PERSONAL} as column_count_after,
        'ISO-8859-1' as encoding from sizes
      union all select 'privacy', 'success', before, before, {_KEPT + _PERSONAL}, {_KEPT}, null from sizes
      union all select 'clean', 'success', before, after, {_KEPT}, {_KEPT + _DERIVED}, null from sizes""",
    "gold_listing": _listing(),
    "model_test_rows": f"""select model, late_delivery_risk as label, rows, true as accuracy_agrees
      from ({ORACLE['ml_split_counts']}) cross join (values ('Logistic Regression'), ('Random Forest')) as m(model)
      where part = 'test'""",
}
