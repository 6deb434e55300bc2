"""SQL fragments shared by the reference queries.

They state the logical tables of ``stratoform.model.views`` a second time, in
plain SQL over the same files, so that a plan is checked against text that
shares none of its code.
"""

from __future__ import annotations


def with_tables(body: str, *names: str) -> str:
    """``body`` with the named fragments, and those they need, as CTEs."""
    return f"{tables(*names)}\n{body}"


def tables(*names: str) -> str:
    """The ``WITH`` clause alone, for more CTEs to follow."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    ctes = ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in needed)
    return f"WITH {ctes}"


def hash1(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def hash2(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 16, 7) AS BIGINT) + 1)"


def cycle(number: str, *choices: str | None) -> str:
    branches = " ".join(
        f"WHEN {i} THEN {'NULL' if c is None else repr(c)}" for i, c in enumerate(choices)
    )
    return f"CASE {number} % {len(choices)} {branches} END"


def _long_tail(chosen: str, number: str) -> str:
    return f"CASE WHEN {chosen} THEN repeat('x', 110) || ({number}) ELSE '' END"


def parsed(digits: str) -> str:
    return (
        f"CASE WHEN length(CAST({digits} AS VARCHAR)) = 8 "
        f"THEN CAST(try_strptime(CAST({digits} AS VARCHAR), '%Y%m%d') AS DATE) END"
    )


def as_int(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def mean(total: str, count: str) -> str:
    return f"(CAST({total} AS DOUBLE) / {count})"


_GROUP = "(p_partkey // 3)"
_CATEGORY = cycle(_GROUP, "AC-HE", "BI-MB", "CL-GL", "CO-PE")
_DELIVERED = cycle(_GROUP, "AC-HE", "BI-MB", "CL-GL", "XX-XX")
_STARTED = (
    f"(TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 3 * 900 + {_GROUP} % 300 AS INTEGER)))"
)
_CHANGED = "(o_orderdate + to_seconds(o_orderkey % 1000000))"
_CUST = "lpad(CAST(o_custkey AS VARCHAR), 8, '0')"
_ORDERED = as_int("o_orderdate")
_PRICE = "CAST(floor(l_extendedprice / l_quantity) AS INTEGER)"
_AMOUNT = "CAST(floor(l_extendedprice) AS INTEGER)"

FRAGMENTS = {
    "sales": """
        SELECT l_orderkey AS sale_id, l_linenumber AS line_number, l_partkey AS product_id,
               l_suppkey AS location_id, o_custkey AS customer_id,
               CAST(l_shipdate AS DATE) AS sale_date, CAST(l_quantity AS BIGINT) AS quantity,
               CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT))
                    // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS unit_price,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
               CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net_amount
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "recent": "SELECT * FROM sales WHERE sale_date >= DATE '1998-01-01'",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, r_name AS region, n_name AS country,
               c_mktsegment AS gender
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category_id,
               p_type AS category_name, CAST(p_retailprice AS DECIMAL(12,2)) AS list_price
        FROM part""",
    "versions": """
        SELECT o_custkey AS customer_id, o_orderkey AS version_id, CAST(o_orderdate AS DATE) AS start_date,
               o_orderpriority AS priority,
               lead(CAST(o_orderdate AS DATE)) OVER
                   (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_start
        FROM orders""",
    "raw_customers": f"""
        SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_custkey END AS cst_id,
               'AW' || {_CUST} AS cst_key,
               '  ' || o_orderpriority || ' ' AS cst_firstname,
               ' ' || lower(o_orderstatus) AS cst_lastname,
               {cycle("o_orderkey", " s", "M ", "S", "m", "x", None)} AS cst_marital_status,
               {cycle("o_orderkey", "f", " M", "F ", "n/a", None)} AS cst_gndr,
               CAST(o_orderdate AS DATE) AS cst_create_date,
               {_CHANGED} AS src_update_at
        FROM orders""",
    "silver_customers": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
               CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married'
                    ELSE 'n/a' END AS cst_marital_status,
               CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END AS cst_gndr,
               cst_create_date
        FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY cst_create_date DESC, src_update_at DESC,
                        cst_key, cst_firstname, cst_lastname, cst_marital_status NULLS LAST,
                        cst_gndr NULLS LAST) AS rn
              FROM raw_customers WHERE cst_id IS NOT NULL)
        WHERE rn = 1""",
    "raw_products": f"""
        SELECT p_partkey AS prd_id, ({_CATEGORY}) || '-P' || {_GROUP}
                   || {_long_tail(f"{_GROUP} % 50 = 7", "p_partkey % 2")} AS prd_key, p_name AS prd_nm,
               CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS prd_cost,
               p_partkey % 41 = 0 AS bad_cost,
               {cycle("p_partkey", "M ", "r", "S ", " t", "z", None)} AS prd_line,
               {_STARTED} AS prd_start_dt
        FROM part""",
    "all_products": """
        SELECT prd_id, replace(substr(prd_key, 1, 5), '-', '_') AS cat_id, substr(prd_key, 7) AS prd_key, prd_nm,
               CAST(coalesce(prd_cost, 0) AS DECIMAL(10,2)) AS prd_cost,
               CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'S' THEN 'Other Sales'
                    WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
               CAST(prd_start_dt AS DATE) AS prd_start_dt,
               CAST(lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt, prd_id)
                    - INTERVAL 1 DAY AS DATE) AS prd_end_dt,
               bad_cost
        FROM raw_products""",
    "silver_products": "SELECT * EXCLUDE (bad_cost) FROM all_products WHERE NOT bad_cost",
    "raw_sales": f"""
        SELECT 'SO' || l_orderkey AS sls_ord_num, 'P' || (l_partkey // 3) AS sls_prd_key, o_custkey AS sls_cust_id,
               CASE WHEN l_orderkey % 17 = 0 THEN 0 WHEN l_orderkey % 19 = 0 THEN {_ORDERED} % 1000000
                    ELSE {_ORDERED} END AS sls_order_dt,
               CASE WHEN l_orderkey % 23 = 0 THEN 20131340 ELSE {as_int("l_shipdate")} END AS sls_ship_dt,
               CASE WHEN l_orderkey % 31 <> 0 THEN {as_int("o_orderdate + INTERVAL 30 DAY")} END AS sls_due_dt,
               CASE l_linenumber WHEN 2 THEN -{_AMOUNT} WHEN 3 THEN NULL ELSE {_AMOUNT} END AS sls_sales,
               CASE l_linenumber WHEN 6 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS sls_quantity,
               CASE l_linenumber WHEN 4 THEN -{_PRICE} WHEN 5 THEN NULL ELSE {_PRICE} END AS sls_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "silver_sales": f"""
        SELECT sls_ord_num, sls_prd_key, sls_cust_id, {parsed("sls_order_dt")} AS sls_order_dt,
               {parsed("sls_ship_dt")} AS sls_ship_dt, {parsed("sls_due_dt")} AS sls_due_dt,
               CASE WHEN sls_sales IS NULL OR sls_sales <= 0 OR sls_sales <> sls_quantity * abs(sls_price)
                    THEN sls_quantity * abs(sls_price) ELSE sls_sales END AS sls_sales,
               sls_quantity,
               CASE WHEN sls_price IS NULL OR sls_price <= 0
                    THEN CAST(trunc(sls_sales / CASE WHEN sls_quantity = 0 THEN 1 ELSE sls_quantity END) AS INTEGER)
                    ELSE sls_price END AS sls_price
        FROM raw_sales""",
    "raw_erp": f"""
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'NAS' ELSE '' END || 'AW' || {_CUST}
                   || {_long_tail("o_orderkey % 40 = 0", "o_orderkey % 3")} AS cid,
               CASE WHEN o_orderkey % 50 = 0 THEN DATE '2999-01-01'
                    ELSE DATE '1940-01-01' + CAST(o_orderkey * 37 % 25000 AS INTEGER) END AS bdate,
               {cycle("o_orderkey", "female ", "M", "F", " Male", "", None, "x")} AS gen,
               {_CHANGED} AS src_update_at
        FROM orders""",
    "silver_erp": """
        SELECT cid, bdate, gen
        FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY src_update_at DESC, bdate NULLS LAST, gen) AS rn
              FROM (SELECT CASE WHEN cid LIKE 'NAS%' THEN substr(cid, 4) ELSE cid END AS cid,
                           CASE WHEN bdate <= DATE '2025-01-01' THEN bdate END AS bdate,
                           CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                                WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gen,
                           src_update_at FROM raw_erp))
        WHERE rn = 1""",
    "raw_locations": f"""
        SELECT 'AW' || CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END || {_CUST} AS cid,
               {cycle("o_orderkey", " DE ", "USA ", "US", "us", " ", None, " France")} AS cntry,
               {_CHANGED} AS src_update_at
        FROM orders""",
    "silver_locations": """
        SELECT cid, cntry
        FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY src_update_at DESC, cntry) AS rn
              FROM (SELECT replace(cid, '-', '') AS cid,
                           CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
                                WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                                WHEN cntry IS NULL OR trim(cntry) = '' THEN 'n/a' ELSE trim(cntry) END AS cntry,
                           src_update_at FROM raw_locations))
        WHERE rn = 1""",
    "silver_categories": f"""
        SELECT id, cat, subcat, maintenance
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed DESC, cat, subcat, maintenance) AS rn
              FROM (SELECT replace({_DELIVERED}, '-', '_') AS id, substr({_DELIVERED}, 1, 2) AS cat, p_type AS subcat,
                           {cycle("p_partkey", "Yes", "No")} AS maintenance, p_partkey % 1000000 AS changed
                    FROM part))
        WHERE rn = 1""",
    "gold_customers": """
        SELECT row_number() OVER (ORDER BY cst_id) AS customer_key, cst_id AS customer_id, cst_key AS customer_number,
               cst_firstname AS first_name, cst_lastname AS last_name, cntry AS country,
               cst_marital_status AS marital_status,
               CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr ELSE coalesce(gen, 'n/a') END AS gender,
               bdate AS birthdate, cst_create_date AS create_date
        FROM silver_customers c LEFT JOIN silver_erp e ON c.cst_key = e.cid
             LEFT JOIN silver_locations l ON c.cst_key = l.cid""",
    "gold_products": """
        SELECT row_number() OVER (ORDER BY prd_start_dt, prd_key, prd_id) AS product_key, prd_id AS product_id,
               prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, cat AS category_name,
               subcat AS subcategory_name, maintenance AS maintenance_flag, CAST(prd_cost AS DOUBLE) AS cost,
               prd_line AS product_line, prd_start_dt AS start_date, prd_end_dt AS end_date
        FROM silver_products p LEFT JOIN silver_categories c ON p.cat_id = c.id""",
    "gold_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
               sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
               sls_quantity AS quantity, sls_price AS unit_price
        FROM silver_sales LEFT JOIN gold_products ON sls_prd_key = product_number
             LEFT JOIN gold_customers ON sls_cust_id = customer_id""",
    "daily": """
        SELECT sale_date, count(*) AS total_sales, sum(net_amount) AS net,
               CAST(sum(net_amount) AS DOUBLE) / count(*) AS avg_sale_amount,
               count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
               min(customer_id) AS min_customer_id, max(customer_id) AS max_customer_id,
               min(product_id) AS min_product_id, max(product_id) AS max_product_id
        FROM sales GROUP BY sale_date""",
    "by_customer": """
        SELECT c.customer_id, customer_name, region, gender, count(s.sale_id) AS total_purchases,
               CAST(sum(net_amount) AS DOUBLE) AS total_spent,
               CAST(sum(net_amount) AS DOUBLE) / count(s.sale_id) AS avg_purchase_amount,
               min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date,
               count(DISTINCT product_id) AS unique_products_bought,
               min(product_id) AS min_product_id, max(product_id) AS max_product_id
        FROM customers c LEFT JOIN sales s ON s.customer_id = c.customer_id
        GROUP BY c.customer_id, customer_name, region, gender""",
    "by_product": """
        SELECT p.product_id, product_name, category_name, CAST(list_price AS DOUBLE) AS unit_price,
               count(s.sale_id) AS total_sales, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
               CAST(sum(net_amount) AS DOUBLE) AS total_revenue,
               CAST(sum(s.unit_price) AS DOUBLE) / count(s.sale_id) AS avg_price,
               count(DISTINCT customer_id) AS unique_customers,
               min(customer_id) AS min_customer_id, max(customer_id) AS max_customer_id
        FROM products p LEFT JOIN sales s ON s.product_id = p.product_id
        GROUP BY p.product_id, product_name, category_name, list_price""",
}


def bloom_parameters(items: str) -> str:
    """Bits and hash functions for the items of a table, one row ``m, k``."""
    return f"""
        SELECT (m + 511) // 512 * 512 AS m, CAST(floor(m / n * ln(2)) AS BIGINT) AS k
        FROM (SELECT n, CAST(floor(-(n * ln(0.01)) / (ln(2) * ln(2))) AS BIGINT) AS m
              FROM (SELECT greatest(count(*), 1) AS n FROM {items}))"""


def bloom_positions(items: str, item: str, parameters: str) -> str:
    """Rows ``item, pos`` for each item and hash function."""
    text = f"CAST({item} AS VARCHAR)"
    return f"""
        SELECT item, h1 % (m // 512) * 512 + (h2 + i * (h2 // 512 * 2 + 1)) % 512 AS pos
        FROM (SELECT {item} AS item, {hash1(text)} AS h1, {hash2(text)} AS h2, m, unnest(range(k)) AS i
              FROM {items}, {parameters})"""


def countmin_cells(items: str, item: str) -> str:
    text = f"CAST({item} AS VARCHAR)"
    return f"""
        SELECT CAST(i AS INTEGER) AS line, (h1 + i * h2) % 1000 AS bucket, count(*) AS total
        FROM (SELECT {hash1(text)} AS h1, {hash2(text)} AS h2, unnest(range(5)) AS i FROM {items})
        GROUP BY 1, 2"""


def countmin_estimates(items: str, item: str, cells: str) -> str:
    """Rows ``item, estimate`` for the distinct items of a table."""
    text = "CAST(item AS VARCHAR)"
    return f"""
        SELECT item, CAST(min(coalesce(total, 0)) AS BIGINT) AS estimate
        FROM (SELECT item, i, ({hash1(text)} + i * {hash2(text)}) % 1000 AS bucket
              FROM (SELECT item, unnest(range(5)) AS i FROM (SELECT DISTINCT {item} AS item FROM {items})))
             AS probe LEFT JOIN {cells} c ON c.line = probe.i AND c.bucket = probe.bucket
        GROUP BY item"""


NEEDS = {
    "recent": ("sales",),
    "silver_customers": ("raw_customers",),
    "all_products": ("raw_products",),
    "silver_products": ("all_products",),
    "silver_sales": ("raw_sales",),
    "silver_erp": ("raw_erp",),
    "silver_locations": ("raw_locations",),
    "gold_customers": ("silver_customers", "silver_erp", "silver_locations"),
    "gold_products": ("silver_products", "silver_categories"),
    "gold_sales": ("silver_sales", "gold_products", "gold_customers"),
    "daily": ("sales",),
    "by_customer": ("customers", "sales"),
    "by_product": ("products", "sales"),
}
