"""Checking SQL of the order warehouse, written independently of the Spark plans."""

from __future__ import annotations

from oracle.compose import compose
from starloom.sources.contracts import BATCH, CONTRACTS, check_sql

STEPS: dict[str, str] = {f"{n}": check_sql(n) for n in CONTRACTS}

_STATES = (
    "'ACKNOWLEDGED','ACK','REJECTED','REJECT','PENDING','HOLD','HELD','IN_PROGRESS','INPROGRESS',"
    "'CANCELLED','CANCEL','COMPLETED','COMPLETE','FAILED','FAIL','PARTIAL'"
)


def _state(c: str) -> str:
    u = f"upper(trim({c}))"
    return (
        f"CASE WHEN {u} IN ('ACKNOWLEDGED','ACK') THEN 'acknowledged' WHEN {u} IN ('REJECTED','REJECT') THEN 'rejected' "
        f"WHEN {u} = 'PENDING' THEN 'pending' WHEN {u} IN ('HOLD','HELD') THEN 'held' "
        f"WHEN {u} IN ('IN_PROGRESS','INPROGRESS') THEN 'inProgress' WHEN {u} IN ('CANCELLED','CANCEL') THEN 'cancelled' "
        f"WHEN {u} IN ('COMPLETED','COMPLETE') THEN 'completed' WHEN {u} IN ('FAILED','FAIL') THEN 'failed' "
        f"WHEN {u} = 'PARTIAL' THEN 'partial' ELSE 'UNKNOWN' END"
    )


def _mask(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^05[0-9]{{8}}$') THEN substr({c},1,3) || '-XXX-X' || substr({c},9,3) "
        f"WHEN regexp_matches({c}, '^9665[0-9]{{8}}$') THEN substr({c},1,6) || '-XXX-X' || substr({c},12,3) "
        f"WHEN regexp_matches({c}, '^\\+9665[0-9]{{8}}$') THEN substr({c},1,7) || '-XXX-X' || substr({c},13,3) "
        f"WHEN regexp_matches({c}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$') "
        f"THEN substr({c},1,1) || '***@' || split_part({c},'@',2) ELSE {c} END"
    )


def _dsk(c: str) -> str:
    return f"(year({c}) * 10000 + month({c}) * 100 + day({c}))::INT"


def _tsk(c: str) -> str:
    return f"(hour({c}) * 100 + minute({c}))::INT"


def _pct(a: str, b: str) -> str:
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0) * 100.0"


STEPS["customer_feed"] = "SELECT DISTINCT customer_id FROM (SELECT customer_id FROM stg_customers_1 UNION ALL SELECT customer_id FROM stg_customers_2) u"
STEPS["item_counts"] = "SELECT order_id, count(*) AS n_items FROM stg_items GROUP BY order_id"
STEPS["dq_base"] = f"""
SELECT *, n_any > 1 AND alive AND rn_any > 1 AS superseded FROM (
  SELECT *, count(*) OVER (PARTITION BY order_id) AS n_any,
         row_number() OVER (PARTITION BY order_id ORDER BY stg_load_dt DESC, stg_record_id DESC) AS rn_any,
         count(*) FILTER (WHERE alive) OVER (PARTITION BY order_id) AS n_alive,
         row_number() OVER (PARTITION BY order_id, alive ORDER BY stg_load_dt DESC, stg_record_id DESC) AS rn_alive
  FROM (
    SELECT *, NOT blank AND NOT badstate AS alive FROM (
      SELECT o.*, trim(coalesce(order_id, '')) = '' AS blank,
             trim(coalesce(order_id, '')) <> '' AND upper(trim(coalesce(order_state, ''))) NOT IN ({_STATES}, '') AS badstate,
             try_cast(total_amount AS DECIMAL(18,2)) AS tot, try_cast(vat_amount AS DECIMAL(18,2)) AS vat
      FROM stg_orders o) a) b) c
"""
STEPS["dq_flags"] = """
SELECT d.*, alive AND NOT superseded AS left6, alive AND NOT superseded AND NOT coalesce(tot < 0, FALSE) AS kept,
       coalesce(alive AND abs(vat::DOUBLE - tot::DOUBLE / 1.15 * 0.15) > 0.01, FALSE) AS wrongvat,
       c.customer_id IS NOT NULL AS customer_known, i.n_items
FROM dq_base d LEFT JOIN customer_feed c ON c.customer_id = d.customer_id
LEFT JOIN item_counts i ON i.order_id = d.order_id
"""
STEPS["checked_orders"] = """
SELECT *, CASE WHEN blank THEN 'DQ-01: order id is missing'
               WHEN badstate THEN 'DQ-02: invalid state ' || coalesce(order_state, 'NULL')
               WHEN superseded THEN 'DQ-06: superseded by a later copy'
               WHEN left6 AND tot < 0 THEN 'DQ-12: negative amount' END AS why,
       CASE WHEN blank OR badstate OR superseded OR (left6 AND coalesce(tot < 0, FALSE)) THEN 'E' ELSE 'V' END AS final_status,
       CASE WHEN wrongvat THEN CAST(CAST(round(tot::DOUBLE / 1.15 * 0.15, 2) AS DECIMAL(18,2)) AS VARCHAR) ELSE vat_amount END AS fixed_vat
FROM dq_flags
"""
_E = "nullif(trim(order_id), '') AS order_id"
STEPS["order_errors"] = f"""
SELECT 'DQ-01' AS code, 'Order ID Not Null' AS rule, 'REJECT' AS sev, 'order_id' AS field, NULL AS val, {_E}, NULL AS item FROM dq_flags WHERE blank
UNION ALL SELECT 'DQ-02','Valid Order State','REJECT','order_state',order_state,{_E},NULL FROM dq_flags WHERE badstate
UNION ALL SELECT 'DQ-03','Date Chronology','WARN','completion_date',completion_date,{_E},NULL FROM dq_flags
  WHERE alive AND try_cast(substr(completion_date,1,10) AS DATE) < try_cast(substr(order_date,1,10) AS DATE)
UNION ALL SELECT 'DQ-04','Customer Reference Exists','WARN','customer_id',customer_id,{_E},NULL FROM dq_flags
  WHERE alive AND customer_id IS NOT NULL AND NOT customer_known
UNION ALL SELECT 'DQ-05','VAT Calculation 15%','WARN','vat_amount',vat_amount,{_E},NULL FROM dq_flags WHERE wrongvat
UNION ALL SELECT 'DQ-06','Duplicate Order in Batch','WARN','order_id',order_id,{_E},NULL FROM dq_flags WHERE alive AND n_alive > 1 AND rn_alive = 1
UNION ALL SELECT 'DQ-07','Mobile Number Format','WARN','notification_contact',notification_contact,{_E},NULL FROM dq_flags
  WHERE left6 AND notification_contact <> '' AND NOT regexp_matches(trim(notification_contact),
    '^(05[0-9]{{8}}|\\+9665[0-9]{{8}}|9665[0-9]{{8}}|[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}})$')
UNION ALL SELECT 'DQ-10','High Value Order','WARN','total_amount',total_amount,{_E},NULL FROM dq_flags WHERE left6 AND tot > 500000
UNION ALL SELECT 'DQ-11','Order Date Not Future','WARN','order_date',order_date,{_E},NULL FROM dq_flags
  WHERE left6 AND try_cast(substr(order_date,1,10) AS DATE) > DATE '2001-08-02'
UNION ALL SELECT 'DQ-12','Negative Amount','REJECT','total_amount',total_amount,{_E},NULL FROM dq_flags WHERE left6 AND tot < 0
UNION ALL SELECT 'DQ-13','Amount Is Numeric','WARN','total_amount',total_amount,{_E},NULL FROM dq_flags WHERE left6 AND total_amount IS NOT NULL AND tot IS NULL
UNION ALL SELECT 'DQ-20','Order Item Count','WARN','order_item_count',order_item_count,{_E},NULL FROM dq_flags
  WHERE kept AND n_items IS NOT NULL AND try_cast(order_item_count AS INT) <> n_items
"""
STEPS["order_errors_of"] = STEPS["order_errors"].replace(f"{_E}, NULL AS item FROM", f"{_E}, NULL AS item, total_amount, customer_id FROM").replace(f"{_E},NULL FROM", f"{_E},NULL,total_amount,customer_id FROM")
STEPS["item_errors"] = """
SELECT 'DQ-08' AS code, 'Product Offering Exists' AS rule, 'WARN' AS sev, 'product_offering_id' AS field, product_offering_id AS val,
       nullif(trim(order_id), '') AS order_id, order_item_id AS item
FROM stg_items i WHERE product_offering_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_offerings_2 p WHERE p.product_offering_id = i.product_offering_id)
  AND NOT EXISTS (SELECT 1 FROM dim_offering d WHERE d.product_offering_bk = i.product_offering_id AND d.current_row_flag = 'Y')
"""
STEPS["customer_errors"] = """
SELECT 'DQ-09' AS code, 'National ID Format' AS rule, 'WARN' AS sev, 'national_id' AS field, '***MASKED***' AS val, NULL AS order_id, NULL AS item
FROM stg_customers_2 WHERE national_id <> '' AND NOT regexp_matches(trim(national_id), '^[12][0-9]{9}$')
"""
STEPS["ods_orders"] = f"""
SELECT order_id AS order_bk, order_href, external_id, try_cast(order_date AS TIMESTAMP) AS order_date,
  try_cast(requested_start_date AS DATE) AS requested_start_dt, try_cast(requested_completion_dt AS DATE) AS requested_completion_dt,
  try_cast(expected_completion_dt AS DATE) AS expected_completion_dt, try_cast(completion_date AS TIMESTAMP) AS completion_dt,
  {_state('order_state')} AS order_state_cd,
  CASE upper(trim(category)) WHEN 'NEW' THEN 'NEW' WHEN 'MODIFY' THEN 'MODIFY' WHEN 'UPGRADE' THEN 'MODIFY' WHEN 'DOWNGRADE' THEN 'MODIFY'
    WHEN 'TERMINATE' THEN 'TERMINATE' WHEN 'SUSPEND' THEN 'SUSPEND' WHEN 'RESUME' THEN 'RESUME' ELSE 'NEW' END AS order_category_cd,
  priority AS priority_cd, cancellation_reason, {_mask('notification_contact')} AS notification_contact,
  coalesce(CASE upper(trim(channel_name)) WHEN 'MYAPP' THEN 'DIGITAL_APP' WHEN 'STC APP' THEN 'DIGITAL_APP' WHEN 'JAWWY' THEN 'DIGITAL_APP'
    WHEN 'WEB' THEN 'DIGITAL_WEB' WHEN 'PORTAL' THEN 'DIGITAL_WEB' WHEN 'STORE' THEN 'RETAIL' WHEN 'RETAIL' THEN 'RETAIL'
    WHEN 'TELESALES' THEN 'TELESALES' WHEN 'CALL CENTER' THEN 'TELESALES' WHEN 'B2B' THEN 'B2B_PORTAL' WHEN 'PARTNER' THEN 'PARTNER'
    ELSE channel_id END, 'UNKNOWN') AS channel_cd,
  customer_id AS customer_bk, billing_account_id, seller_id AS seller_party_bk, coalesce(upper(trim(segment)), 'CONSUMER') AS segment_cd,
  try_cast(order_item_count AS INT) AS order_item_count, coalesce(tot, 0)::DECIMAL(18,2) AS total_order_amount,
  CAST(round(coalesce(tot, 0)::DOUBLE / 1.15, 2) AS DECIMAL(18,2)) AS order_amount_excl_vat,
  CASE WHEN try_cast(fixed_vat AS DECIMAL(18,2)) > 0 THEN try_cast(fixed_vat AS DECIMAL(18,2))
       ELSE CAST(round(coalesce(tot, 0)::DOUBLE / 1.15 * 0.15, 2) AS DECIMAL(18,2)) END AS vat_amount,
  coalesce(try_cast(discount_amount AS DECIMAL(18,2)), 0)::DECIMAL(18,2) AS discount_amount,
  region_code AS delivery_region, stg_source_system AS source_system_cd,
  md5(coalesce(upper(trim(order_state)), '') || coalesce(expected_completion_dt, '') || coalesce(requested_completion_dt, '')
      || coalesce(upper(trim(segment)), '')) AS change_hash
FROM checked_orders WHERE final_status = 'V'
"""
STEPS["ods_items"] = f"""
SELECT *, CAST(unit_price_incl_vat * item_quantity AS DECIMAL(18,2)) AS item_total_amount,
  CAST(unit_price_excl_vat * 0.15::DECIMAL(3,2) * item_quantity AS DECIMAL(14,2)) AS item_vat_amount,
  CASE WHEN price_type = 'recurring' THEN CAST(unit_price_incl_vat AS DECIMAL(14,2)) ELSE 0 END AS item_mrc,
  CASE WHEN price_type = 'recurring' THEN 0 ELSE CAST(unit_price_incl_vat AS DECIMAL(14,2)) END AS item_otc
FROM (
  SELECT order_id AS order_bk, order_item_id, {_state('item_state')} AS item_state_cd, action AS action_cd,
    product_offering_id AS product_offering_bk, product_spec_id AS product_spec_bk, coalesce(try_cast(item_quantity AS INT), 1) AS item_quantity,
    CASE WHEN price_tax_included_flag = 'Y' THEN CAST(round(price_amount::DOUBLE / 1.15, 4) AS DECIMAL(14,4)) ELSE price_amount::DECIMAL(14,4) END AS unit_price_excl_vat,
    CASE WHEN price_tax_included_flag = 'Y' THEN price_amount::DECIMAL(14,4) ELSE CAST(price_amount::DECIMAL(14,2) * 1.15::DECIMAL(3,2) AS DECIMAL(14,4)) END AS unit_price_incl_vat,
    price_type, try_cast(discount_amount AS DECIMAL(18,2)) AS item_discount_amount, {_mask('product_msisdn')} AS product_msisdn_masked,
    product_sim_type AS sim_type_cd, try_cast(product_contract_months AS INT) AS contract_months, upper(technology_tier) AS technology_tier,
    CASE WHEN is_5g = 'true' THEN 'Y' ELSE 'N' END AS is_5g_item, CASE WHEN is_bundle = 'true' THEN 'Y' ELSE 'N' END AS is_bundle_item,
    shipping_region AS delivery_region, shipping_postcode AS delivery_postal_code
  FROM stg_items) p
"""


def _cust(n: int) -> str:
    return f"""
SELECT customer_id AS customer_bk, coalesce(customer_type, 'INDIVIDUAL') AS customer_type_cd,
  CASE WHEN national_id <> '' THEN sha256(trim(national_id)) END AS national_id_hash, nationality_code AS nationality_cd,
  credit_rating AS credit_rating_cd, customer_segment AS customer_segment_cd, lifetime_value_tier, city AS city_nm, region AS region_nm,
  postal_code, coalesce(preferred_language, 'AR') AS preferred_language, activation_date::DATE AS activation_dt,
  churn_risk_score::DECIMAL(5,4) AS churn_risk_score, CASE WHEN customer_segment IN ('PLATINUM','VIP') THEN 'Y' ELSE 'N' END AS is_vip_flag,
  CASE WHEN customer_type = 'GOV' THEN 'Y' ELSE 'N' END AS is_gov_entity,
  md5(coalesce(customer_segment,'') || coalesce(lifetime_value_tier,'') || coalesce(credit_rating,'') || coalesce(region,'') || coalesce(city,'')) AS change_hash
FROM stg_customers_{n}"""


def _scd2(one: str, two: str, bk: str, sk: str, type1: tuple[str, ...] = ()) -> str:
    t1 = "".join(f", n.{c} AS new_{c}" for c in type1)
    rep = ", ".join(f"CASE WHEN new_hash = change_hash THEN new_{c} ELSE {c} END AS {c}" for c in type1)
    star = f"* EXCLUDE (new_hash{''.join(', new_' + c for c in type1)})" + (f" REPLACE ({rep})" if type1 else "")
    return f"""
SELECT {star}, CASE WHEN new_hash <> change_hash THEN DATE '2001-07-31' ELSE DATE '9999-12-31' END AS row_exp_dt,
       CASE WHEN new_hash <> change_hash THEN 'N' ELSE 'Y' END AS current_row_flag
FROM (SELECT o.*, row_number() OVER (ORDER BY o.{bk}) AS {sk}, DATE '2001-07-01' AS row_eff_dt, n.change_hash AS new_hash{t1}
      FROM {one} o LEFT JOIN {two} n ON n.{bk} = o.{bk}) k
UNION ALL BY NAME
SELECT n.*, (SELECT count(*) FROM {one}) + row_number() OVER (ORDER BY n.{bk}) AS {sk}, DATE '2001-08-01' AS row_eff_dt,
       DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag
FROM {two} n WHERE NOT EXISTS (SELECT 1 FROM {one} o WHERE o.{bk} = n.{bk} AND o.change_hash = n.change_hash)
"""


STEPS["conf_customers_1"], STEPS["conf_customers_2"] = _cust(1), _cust(2)
STEPS["dim_customer"] = _scd2("conf_customers_1", "conf_customers_2", "customer_bk", "customer_sk", ("churn_risk_score", "is_vip_flag")) + """
UNION ALL BY NAME SELECT -1 AS customer_sk, 'UNKNOWN' AS customer_bk, 'UNKNOWN' AS customer_type_cd, 'UNKNOWN' AS customer_segment_cd,
  'UNKNOWN' AS lifetime_value_tier, 'Unknown' AS city_nm, 'Unknown' AS region_nm, 'AR' AS preferred_language, 'N' AS is_vip_flag,
  'N' AS is_gov_entity, DATE '2000-01-01' AS row_eff_dt, DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag
"""


def _offer(n: int) -> str:
    return f"""
SELECT product_offering_id AS product_offering_bk, product_offering_name, product_offering_desc, product_spec_id, product_spec_name,
  upper(trim(product_type)) AS product_type_cd, upper(trim(product_category)) AS product_category_cd, product_family AS product_family_nm,
  upper(trim(technology_tier)) AS technology_tier, is_5g AS is_5g_flag, is_bundle AS is_bundle_flag,
  CASE WHEN upper(product_type) = 'IOT' THEN 'Y' ELSE 'N' END AS is_iot_flag, try_cast(contract_duration AS INT) AS contract_duration_months,
  launch_date::DATE AS launch_dt, end_of_sale_date::DATE AS end_of_sale_dt, base_price::DECIMAL(14,4) AS base_price,
  CAST(base_price::DECIMAL(14,2) * 1.15::DECIMAL(3,2) AS DECIMAL(14,4)) AS base_price_incl_vat, coalesce(currency, 'SAR') AS currency_cd,
  md5(coalesce(product_offering_name,'') || coalesce(product_type,'') || coalesce(product_family,'') || coalesce(technology_tier,'')
      || coalesce(contract_duration,'')) AS change_hash
FROM stg_offerings_{n}"""


STEPS["conf_offerings_1"], STEPS["conf_offerings_2"] = _offer(1), _offer(2)
STEPS["dim_offering"] = _scd2("conf_offerings_1", "conf_offerings_2", "product_offering_bk", "product_offering_sk") + """
UNION ALL BY NAME SELECT -1 AS product_offering_sk, 'UNKNOWN' AS product_offering_bk, 'Unknown Product' AS product_offering_name,
  'UNKNOWN' AS product_type_cd, 'UNKNOWN' AS product_category_cd, 'UNKNOWN' AS product_family_nm, 'UNKNOWN' AS technology_tier,
  'N' AS is_5g_flag, 'N' AS is_bundle_flag, 'N' AS is_iot_flag, 0 AS contract_duration_months, 0 AS base_price, 0 AS base_price_incl_vat,
  'SAR' AS currency_cd, DATE '2000-01-01' AS row_eff_dt, DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag
"""
STEPS["dim_geography"] = """
SELECT row_number() OVER (ORDER BY geography_bk) AS geography_sk, * FROM ref_geography
UNION ALL BY NAME SELECT -1 AS geography_sk, 'UNKNOWN' AS geography_bk, 'SAU' AS country_cd, 'UNKNOWN' AS admin_region_cd,
  'Unknown Region' AS admin_region_nm_en, 'منطقة غير معروفة' AS admin_region_nm_ar, 'UNKNOWN' AS city_nm_en, 'N' AS has_5g_coverage, 'N' AS has_fiber_coverage
"""
STEPS["dim_party"] = """
SELECT row_number() OVER (ORDER BY party_bk) AS party_sk, *,
  md5(coalesce(party_role_cd,'') || coalesce(party_type_cd,'') || coalesce(party_name,'') || coalesce(agent_id,'') || coalesce(agent_store_cd,'')
      || coalesce(department_cd,'')) AS change_hash,
  DATE '2001-07-01' AS row_eff_dt, DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag FROM ref_parties
UNION ALL BY NAME SELECT -1 AS party_sk, 'UNKNOWN' AS party_bk, 'Unknown' AS party_name, DATE '2000-01-01' AS row_eff_dt,
  DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag
"""
STEPS["dim_state"] = """
SELECT * FROM (VALUES (1,'acknowledged','ACTIVE','N',1),(2,'rejected','TERMINAL','Y',9),(3,'pending','PAUSED','N',3),(4,'held','PAUSED','N',4),
 (5,'inProgress','ACTIVE','N',5),(6,'cancelled','TERMINAL','Y',7),(7,'completed','TERMINAL','Y',6),(8,'failed','TERMINAL','Y',8),
 (9,'partial','TERMINAL','Y',6),(-1,'UNKNOWN','ACTIVE','N',99)) t(order_state_sk, order_state_cd, state_category, is_terminal_state, sort_order)
"""
STEPS["dim_channel"] = """
SELECT * FROM (VALUES (1,'DIGITAL_APP','DIGITAL','MOBILE_APP','Y'),(2,'DIGITAL_WEB','DIGITAL','WEB','Y'),(3,'RETAIL','PHYSICAL','IN_STORE','N'),
 (4,'TELESALES','ASSISTED','IVRS','N'),(5,'B2B_PORTAL','DIGITAL','WEB','Y'),(6,'PARTNER','INDIRECT','API','N'),(-1,'UNKNOWN','UNKNOWN','UNKNOWN','N'))
 t(channel_sk, channel_cd, channel_type_cd, medium_cd, is_digital_flag)
"""
STEPS["dim_action"] = "SELECT * FROM (VALUES (1,'add'),(2,'modify'),(3,'delete'),(4,'noChange'),(-1,'UNKNOWN')) t(action_sk, action_cd)"
STEPS["hijri_months"] = """
SELECT * FROM (VALUES (1,'محرم'),(2,'صفر'),(3,'ربيع الأول'),(4,'ربيع الآخر'),(5,'جمادى الأولى'),(6,'جمادى الآخرة'),(7,'رجب'),(8,'شعبان'),
 (9,'رمضان'),(10,'شوال'),(11,'ذو القعدة'),(12,'ذو الحجة')) t(hm, hijri_month_nm_ar)
"""
# the other well-known integer form of the tabular calendar
STEPS["hijri_days"] = """
SELECT full_date, (24 * l4) // 709 AS hm, l4 - (709 * ((24 * l4) // 709)) // 24 AS hd, 30 * n + j - 30 AS hy FROM (
 SELECT *, l3 - ((30 - j) // 15) * ((17719 * j) // 50) - (j // 16) * ((15238 * j) // 43) + 29 AS l4 FROM (
  SELECT *, ((10985 - l3) // 5316) * ((50 * l3) // 17719) + (l3 // 5670) * ((43 * l3) // 15238) AS j FROM (
   SELECT *, l1 - 10631 * n + 354 AS l3 FROM (
    SELECT full_date, l1, (l1 - 1) // 10631 AS n FROM (
     SELECT d::DATE AS full_date, (d::DATE - DATE '1970-01-01') + 2440588 - 1948440 + 10632 AS l1
     FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2031-12-31', INTERVAL 1 DAY) g(d)) a) b) c) e) f
"""
STEPS["dim_date"] = f"""
SELECT {_dsk('h.full_date')} AS date_sk, h.full_date, dayofweek(h.full_date) + 1 AS day_of_week_num, dayname(h.full_date) AS day_of_week_nm_en,
 day(h.full_date) AS day_of_month, dayofyear(h.full_date) AS day_of_year, weekofyear(h.full_date) AS week_of_year, month(h.full_date) AS month_num,
 monthname(h.full_date) AS month_nm_en, quarter(h.full_date) AS quarter_num, year(h.full_date) AS year_num, strftime(h.full_date, '%Y-%m') AS year_month,
 'FY' || year(h.full_date) || 'Q' || quarter(h.full_date) AS fiscal_quarter, 'FY' || year(h.full_date) || 'M' || lpad(month(h.full_date)::VARCHAR, 2, '0') AS fiscal_month,
 hd::INT AS hijri_day, h.hm::INT AS hijri_month_num, hijri_month_nm_ar, hy::INT AS hijri_year,
 lpad(hd::VARCHAR, 2, '0') || '/' || lpad(h.hm::VARCHAR, 2, '0') || '/' || hy::VARCHAR || '-H' AS hijri_date,
 CASE WHEN dayofweek(h.full_date) IN (5, 6) THEN 'N' ELSE 'Y' END AS is_weekday, CASE WHEN dayofweek(h.full_date) IN (5, 6) THEN 'Y' ELSE 'N' END AS is_weekend,
 CASE WHEN h.hm = 9 THEN 'Y' ELSE 'N' END AS is_ramadan, CASE WHEN h.hm = 12 AND hd BETWEEN 8 AND 13 THEN 'Y' ELSE 'N' END AS is_hajj_period,
 CASE WHEN month(h.full_date + 1) <> month(h.full_date) THEN 'Y' ELSE 'N' END AS is_last_day_of_month,
 CASE WHEN quarter(h.full_date + 1) <> quarter(h.full_date) THEN 'Y' ELSE 'N' END AS is_last_day_of_quarter
FROM hijri_days h JOIN hijri_months m ON m.hm = h.hm
"""
STEPS["dim_order"] = """
SELECT row_number() OVER (ORDER BY order_bk) AS order_sk, order_bk, order_href, external_id, order_date, requested_start_dt, requested_completion_dt,
 expected_completion_dt, completion_dt, order_state_cd, order_category_cd, priority_cd, cancellation_reason, notification_contact, segment_cd,
 billing_account_id, channel_cd, change_hash, DATE '2001-08-01' AS row_eff_dt, DATE '9999-12-31' AS row_exp_dt, 'Y' AS current_row_flag FROM ods_orders
"""
STEPS["headers"] = "SELECT *, coalesce(TRY_CAST(substr(order_bk, 2) AS BIGINT), 0) AS n FROM ods_orders"
STEPS["headers_earlier"] = """
SELECT order_bk, CASE WHEN n % 5 = 0 THEN 'pending' ELSE order_state_cd END AS order_state_cd,
 CASE WHEN n % 5 = 0 THEN md5(change_hash || 'x') ELSE change_hash END AS change_hash, row_number() OVER (ORDER BY order_bk) AS order_sk FROM headers WHERE n % 3 <> 0
"""
STEPS["fact_transition"] = f"""
SELECT row_number() OVER (ORDER BY e.order_id, evt, e.stg_record_id) AS transition_sk, o.order_sk,
 coalesce(f.order_state_sk, -1) AS from_state_sk, coalesce(t.order_state_sk, -1) AS to_state_sk, {_dsk('evt')} AS transition_date_sk,
 {_tsk('evt')} AS transition_time_sk, coalesce(p.party_sk, -1) AS changed_by_party_sk, e.order_id AS order_bk, change_reason_code AS change_reason_cd,
 change_reason_desc, coalesce(is_automated_change, 'N') AS is_automated_change, event_source AS event_source_cd,
 CASE WHEN prev IS NULL THEN 0 ELSE date_sub('hour', prev, evt) END AS hrs,
 CASE WHEN from_cd IN ('acknowledged','inProgress','pending') THEN 'Y' ELSE 'N' END AS is_sla_critical_state,
 CASE WHEN prev IS NOT NULL THEN date_sub('hour', first_evt, evt)::DOUBLE / 24.0 * 100.0 END AS sla_elapsed_pct
FROM (SELECT *, event_timestamp::TIMESTAMP AS evt, lag(event_timestamp::TIMESTAMP) OVER w AS prev,
        min(event_timestamp::TIMESTAMP) OVER (PARTITION BY order_id) AS first_evt, {_state('from_state')} AS from_cd, {_state('to_state')} AS to_cd
      FROM stg_events WINDOW w AS (PARTITION BY order_id ORDER BY event_timestamp::TIMESTAMP, stg_record_id)) e
JOIN dim_order o ON o.order_bk = e.order_id
LEFT JOIN dim_state f ON f.order_state_cd = from_cd LEFT JOIN dim_state t ON t.order_state_cd = to_cd
LEFT JOIN dim_party p ON p.party_bk = e.changed_by_user_id
"""
STEPS["primary_offer"] = """
SELECT order_bk, product_offering_bk FROM (SELECT *, row_number() OVER (PARTITION BY order_bk ORDER BY unit_price_incl_vat DESC, order_item_id DESC) AS rn
 FROM ods_items) q WHERE rn = 1
"""
STEPS["fact_base"] = f"""
SELECT o.*, d.order_sk, {_dsk('o.order_date')} AS date_sk, coalesce(c.customer_sk, -1) AS customer_sk, p.product_offering_sk AS psk,
 p.is_5g_flag, p.is_bundle_flag, p.product_type_cd, p.contract_duration_months,
 CASE WHEN completion_dt IS NOT NULL THEN date_sub('hour', o.order_date, o.completion_dt) END AS hrs,
 CASE o.segment_cd WHEN 'ENTERPRISE' THEN 4 WHEN 'SMB' THEN 8 ELSE 24 END AS simple_sla
FROM (SELECT * FROM ods_orders) o JOIN (SELECT order_bk, order_sk FROM dim_order) d ON d.order_bk = o.order_bk
LEFT JOIN (SELECT * FROM dim_customer WHERE current_row_flag = 'Y') c ON c.customer_bk = o.customer_bk
LEFT JOIN primary_offer po ON po.order_bk = o.order_bk
LEFT JOIN (SELECT * FROM dim_offering WHERE current_row_flag = 'Y') p ON p.product_offering_bk = po.product_offering_bk
"""
STEPS["fact_order"] = f"""
SELECT order_sk * 100000000 + date_sk AS order_snapshot_key, order_sk, date_sk, customer_sk, coalesce(psk, -1) AS product_offering_sk,
 coalesce(ch.channel_sk, -1) AS channel_sk, coalesce(g.geography_sk, -1) AS geography_sk, coalesce(s.order_state_sk, -1) AS order_state_sk,
 {_tsk('order_date')} AS time_sk, coalesce(rp.party_sk, -1) AS seller_party_sk, total_order_amount, order_amount_excl_vat, vat_amount, discount_amount,
 0::DECIMAL(14,2) AS recurring_charge_mrc, 0::DECIMAL(14,2) AS one_time_charge_otc, 0::DECIMAL(18,2) AS expected_annual_revenue,
 coalesce(order_item_count, 0) AS order_item_count, hrs AS fulfilment_duration_hrs,
 (SELECT count(*) FROM fact_transition t WHERE t.order_bk = b.order_bk) AS state_transition_count,
 CASE WHEN segment_cd = 'ENTERPRISE' THEN 4 WHEN segment_cd = 'SMB' THEN 8 WHEN is_5g_flag = 'Y' THEN 12 WHEN product_type_cd = 'FIBER' THEN 48 ELSE 24 END AS sla_target_hrs,
 CASE WHEN completion_dt IS NULL THEN simple_sla - date_sub('hour', order_date, TIMESTAMP '2001-08-01 12:00:00') END AS sla_remaining_hrs,
 priority_cd, order_category_cd, CASE WHEN hrs > simple_sla THEN 'Y' ELSE 'N' END AS sla_breach_flag,
 CASE WHEN order_state_cd IN ('held','failed') THEN 'Y' ELSE 'N' END AS fallout_flag, coalesce(is_bundle_flag, 'N') AS is_bundle_order,
 coalesce(is_5g_flag, 'N') AS is_5g_order, coalesce(ch.is_digital_flag, 'N') AS is_digital_channel,
 CASE WHEN min(date_sk) OVER (PARTITION BY customer_sk) < date_sk THEN 'N' ELSE 'Y' END AS is_new_customer_order,
 CASE WHEN order_category_cd = 'MODIFY' THEN 'Y' ELSE 'N' END AS is_upgrade_order, source_system_cd
FROM fact_base b LEFT JOIN dim_channel ch ON ch.channel_cd = b.channel_cd
LEFT JOIN dim_geography g ON g.geography_bk = b.delivery_region LEFT JOIN dim_state s USING (order_state_cd)
LEFT JOIN dim_party rp ON rp.party_bk = b.seller_party_bk
"""
STEPS["fact_item"] = f"""
SELECT row_number() OVER (ORDER BY i.order_bk, i.order_item_id) AS order_item_sk, o.order_sk, {_dsk('o.order_date')} AS date_sk,
 coalesce(c.customer_sk, -1) AS customer_sk, coalesce(p.product_offering_sk, -1) AS product_offering_sk, coalesce(s.order_state_sk, -1) AS item_state_sk,
 coalesce(a.action_sk, -1) AS action_sk, coalesce(g.geography_sk, -1) AS geography_sk, coalesce(ch.channel_sk, -1) AS channel_sk, i.order_item_id,
 unit_price_excl_vat, unit_price_incl_vat, item_quantity, item_total_amount, coalesce(item_discount_amount, 0)::DECIMAL(18,2) AS item_discount_amount,
 item_vat_amount, item_mrc, item_otc, CASE WHEN p.product_type_cd = 'FIBER' THEN 48 WHEN p.is_5g_flag = 'Y' THEN 12 ELSE 24 END AS item_sla_target_hrs,
 product_msisdn_masked, sim_type_cd, contract_months, i.technology_tier, is_5g_item, is_bundle_item
FROM ods_items i JOIN dim_order o ON o.order_bk = i.order_bk JOIN ods_orders h ON h.order_bk = i.order_bk
LEFT JOIN (SELECT * FROM dim_customer WHERE current_row_flag = 'Y') c ON c.customer_bk = h.customer_bk
LEFT JOIN (SELECT * FROM dim_offering WHERE current_row_flag = 'Y') p ON p.product_offering_bk = i.product_offering_bk
LEFT JOIN dim_state s ON s.order_state_cd = i.item_state_cd LEFT JOIN dim_action a ON a.action_cd = i.action_cd
LEFT JOIN dim_geography g ON g.geography_bk = i.delivery_region || coalesce(i.delivery_postal_code, '')
LEFT JOIN dim_channel ch ON ch.channel_cd = h.channel_cd
"""
# every order attribute a mart or report may need, on one row per order
STEPS["wide"] = """
SELECT f.*, d.full_date, d.year_num, d.month_num, d.month_nm_en, d.week_of_year, d.year_month, d.hijri_month_nm_ar, st.order_state_cd, st.is_terminal_state,
 ch.channel_cd, ch.channel_type_cd, ch.medium_cd, ch.is_digital_flag, o.segment_cd, o.order_bk, o.order_date, p.product_type_cd, p.product_family_nm, p.technology_tier,
 p.product_offering_name, g.admin_region_cd, g.admin_region_nm_en, g.admin_region_nm_ar, g.has_5g_coverage
FROM fact_order f JOIN dim_date d ON d.date_sk = f.date_sk JOIN dim_state st ON st.order_state_sk = f.order_state_sk
JOIN dim_channel ch ON ch.channel_sk = f.channel_sk JOIN dim_order o ON o.order_sk = f.order_sk
LEFT JOIN (SELECT * FROM dim_offering WHERE current_row_flag = 'Y') p ON p.product_offering_sk = f.product_offering_sk
LEFT JOIN dim_geography g ON g.geography_sk = f.geography_sk
"""
STEPS["kpi"] = f"""
SELECT date_sk AS kpi_date_sk, full_date AS kpi_date, channel_cd, order_state_cd, order_category_cd, coalesce(segment_cd,'CONSUMER') AS segment_cd,
 coalesce(admin_region_cd,'UNKNOWN') AS admin_region_cd, coalesce(product_type_cd,'UNKNOWN') AS product_type_cd,
 coalesce(product_family_nm,'UNKNOWN') AS product_family_nm, coalesce(technology_tier,'UNKNOWN') AS technology_tier, is_5g_order AS is_5g_flag,
 is_bundle_order AS is_bundle_flag, count(*) AS total_orders, count(*) FILTER (WHERE order_state_cd = 'completed') AS completed_orders,
 count(*) FILTER (WHERE order_state_cd = 'cancelled') AS cancelled_orders, count(*) FILTER (WHERE order_state_cd = 'failed') AS failed_orders,
 count(*) FILTER (WHERE order_state_cd IN ('pending','held')) AS pending_orders, sum(total_order_amount) AS gross_order_value,
 sum(total_order_amount - discount_amount) AS net_order_value, sum(vat_amount) AS vat_collected, sum(recurring_charge_mrc) AS total_mrc,
 sum(one_time_charge_otc) AS total_otc, sum(discount_amount) AS total_discount, sum(total_order_amount)::DOUBLE / count(*) AS avg_order_value,
 sum(expected_annual_revenue) AS expected_annual_revenue, count(*) FILTER (WHERE sla_breach_flag = 'Y') AS sla_breached_orders,
 count(*) FILTER (WHERE sla_breach_flag = 'N' AND order_state_cd = 'completed') AS sla_compliant_orders,
 {_pct("count(*) FILTER (WHERE sla_breach_flag = 'N' AND order_state_cd = 'completed')", "count(*) FILTER (WHERE order_state_cd = 'completed')")} AS sla_compliance_rate_pct,
 sum(fulfilment_duration_hrs)::DOUBLE / count(fulfilment_duration_hrs) AS avg_fulfilment_hrs, max(fulfilment_duration_hrs) AS max_fulfilment_hrs,
 count(*) FILTER (WHERE fulfilment_duration_hrs <= 24) AS orders_within_24hrs, count(*) FILTER (WHERE fulfilment_duration_hrs <= 48) AS orders_within_48hrs,
 count(*) FILTER (WHERE fallout_flag = 'Y') AS fallout_orders, {_pct("count(*) FILTER (WHERE fallout_flag = 'Y')", "count(*)")} AS fallout_rate_pct,
 count(DISTINCT customer_sk) AS unique_customers, count(*) FILTER (WHERE is_new_customer_order = 'Y') AS new_customer_orders,
 count(*) FILTER (WHERE is_upgrade_order = 'Y') AS upgrade_orders, count(*) FILTER (WHERE is_digital_channel = 'Y') AS digital_orders,
 {_pct("count(*) FILTER (WHERE is_digital_channel = 'Y')", "count(*)")} AS digital_order_share_pct,
 count(*) FILTER (WHERE is_bundle_order = 'Y') AS bundle_orders, count(*) FILTER (WHERE is_5g_order = 'Y') AS order_5g_count,
 sum(order_item_count) AS total_order_items, sum(order_item_count)::DOUBLE / count(order_item_count) AS avg_items_per_order
FROM wide GROUP BY 1,2,3,4,5,6,7,8,9,10,11,12
"""


def _d(*cols: str) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in cols)


def _ints(*cols: str) -> str:
    return ", ".join(f"{c}::BIGINT AS {c}" for c in cols)


_DONE = "order_state_cd = 'completed'"
_CUR_P = "(SELECT * FROM dim_offering WHERE current_row_flag = 'Y')"
_CUR_C = "(SELECT * FROM dim_customer WHERE current_row_flag = 'Y')"

FINAL: dict[str, str] = {
    "order_dq_checked_batch": "SELECT stg_record_id, order_id, final_status AS stg_record_status, why AS stg_error_desc, fixed_vat AS vat_amount FROM checked_orders",
    "order_dq_error_log": """
SELECT code AS err_rule_code, rule AS err_rule_name, sev AS err_severity, src AS err_source_table, field AS err_field_name, val AS err_field_value, order_id, item AS order_item_id
FROM (SELECT *, 'stg_product_order' AS src FROM order_errors UNION ALL SELECT *, 'stg_product_order_item' FROM item_errors UNION ALL SELECT *, 'stg_customer' FROM customer_errors) u""",
    "order_dq_scorecard": f"""
SELECT '{BATCH}' AS batch_id, code AS err_rule_code, rule AS err_rule_name, sev AS err_severity, src AS err_source_table, count(*) AS error_count,
 count(DISTINCT order_id) AS orders_affected, {_pct("count(DISTINCT order_id)", "(SELECT count(DISTINCT order_id) FROM stg_orders)")} AS pct_orders_affected,
 DATE '2001-08-01' AS batch_date
FROM (SELECT *, 'stg_product_order' AS src FROM order_errors UNION ALL SELECT *, 'stg_product_order_item' FROM item_errors UNION ALL SELECT *, 'stg_customer' FROM customer_errors) u
GROUP BY code, rule, sev, src""",
    "order_dq_batch_score": f"""
SELECT stg_batch_id AS batch_id, count(*) AS total_records, count(*) FILTER (WHERE final_status = 'V') AS valid_records,
 count(*) FILTER (WHERE final_status = 'E') AS rejected_records, {_pct("count(*) FILTER (WHERE final_status = 'V')", "count(*)")} AS dq_pass_rate_pct,
 CASE WHEN count(*) FILTER (WHERE final_status = 'V') * 100.0 / count(*) >= 97 THEN 'PASS' ELSE 'FAIL - BATCH HALTED' END AS dq_verdict
FROM checked_orders GROUP BY 1""",
    "ods_orders": f"SELECT * EXCLUDE (total_order_amount, order_amount_excl_vat, vat_amount, discount_amount), {_d('total_order_amount','order_amount_excl_vat','vat_amount','discount_amount')} FROM ods_orders",
    "ods_items": f"""SELECT * EXCLUDE (price_type, unit_price_excl_vat, unit_price_incl_vat, item_total_amount, item_discount_amount, item_vat_amount, item_mrc, item_otc),
 {_d('unit_price_excl_vat','unit_price_incl_vat','item_total_amount','item_discount_amount','item_vat_amount','item_mrc','item_otc')} FROM ods_items""",
    "payload_items": """
SELECT 'O' || o_orderkey AS order_id, '1' AS order_item_id, (o_orderkey % 9 + 1)::VARCHAR AS item_quantity, 'pending' AS item_state, 'add' AS action,
 'P' || (o_orderkey % 200) AS product_offering_id, 'SP1' AS product_spec_id, 'recurring' AS price_type, o_totalprice::DECIMAL(18,2)::VARCHAR AS price_amount FROM orders
UNION ALL SELECT 'O' || o_orderkey, '2', '1', 'held', 'delete', NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 2 = 0""",
    "dim_customer_history": f"SELECT * EXCLUDE (churn_risk_score), {_d('churn_risk_score')} FROM dim_customer",
    "dim_offering_history": f"SELECT * EXCLUDE (base_price, base_price_incl_vat), {_d('base_price','base_price_incl_vat')} FROM dim_offering",
    "dim_order_history": "SELECT * FROM dim_order",
    "dim_geography": "SELECT * FROM dim_geography",
    "dim_related_party": "SELECT * FROM dim_party",
    "customer_change_classes": """
SELECT n.customer_bk, CASE WHEN o.customer_bk IS NULL THEN 'NEW' WHEN o.change_hash <> n.change_hash THEN 'SCD2_CHANGE'
 WHEN o.churn_risk_score <> n.churn_risk_score OR o.is_vip_flag <> n.is_vip_flag THEN 'SCD1_CHANGE' ELSE 'UNCHANGED' END AS change_type
FROM conf_customers_2 n LEFT JOIN conf_customers_1 o ON o.customer_bk = n.customer_bk""",
    "order_customer_as_recorded": """
SELECT f.order_bk, f.order_date, c.customer_sk, c.customer_segment_cd FROM ods_orders f LEFT JOIN dim_customer c
 ON c.customer_bk = f.customer_bk AND f.order_date::DATE BETWEEN c.row_eff_dt AND c.row_exp_dt""",
    "order_calendar_use": """
SELECT d.date_sk, d.full_date, day_of_week_num, day_of_week_nm_en, day_of_month, day_of_year, week_of_year, month_num, month_nm_en, quarter_num, year_num, year_month,
 fiscal_quarter, fiscal_month, hijri_day, hijri_month_num, hijri_month_nm_ar, hijri_year, hijri_date, is_weekday, is_weekend, is_ramadan, is_hajj_period,
 is_last_day_of_month, is_last_day_of_quarter, 'Q' || quarter_num || ' ' || year_num AS quarter_nm, year_num AS fiscal_year,
 CASE day_of_week_num WHEN 1 THEN 'الأحد' WHEN 2 THEN 'الاثنين' WHEN 3 THEN 'الثلاثاء' WHEN 4 THEN 'الأربعاء' WHEN 5 THEN 'الخميس' WHEN 6 THEN 'الجمعة' ELSE 'السبت' END AS day_of_week_nm_ar,
 CASE month_num WHEN 1 THEN 'يناير' WHEN 2 THEN 'فبراير' WHEN 3 THEN 'مارس' WHEN 4 THEN 'أبريل' WHEN 5 THEN 'مايو' WHEN 6 THEN 'يونيو' WHEN 7 THEN 'يوليو' WHEN 8 THEN 'أغسطس'
  WHEN 9 THEN 'سبتمبر' WHEN 10 THEN 'أكتوبر' WHEN 11 THEN 'نوفمبر' ELSE 'ديسمبر' END AS month_nm_ar,
 CASE strftime(d.full_date, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '09-23' THEN 'National Day' END AS holiday_nm,
 CASE WHEN strftime(d.full_date, '%m-%d') IN ('01-01', '09-23') THEN 'Y' ELSE 'N' END AS is_public_holiday, count(o.o_orderkey) AS orders
FROM dim_date d JOIN orders o ON o.o_orderdate::DATE = d.full_date GROUP BY ALL""",
    "order_time_use": """
SELECT hour(ts) * 100 + minute(ts) AS time_sk, hour(ts) AS hour_24, minute(ts) AS minute_of_hour,
 CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'Afternoon' WHEN hour(ts) BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_of_day_nm,
 CASE WHEN hour(ts) BETWEEN 1 AND 6 THEN 'NIGHT_BATCH' WHEN hour(ts) BETWEEN 8 AND 21 THEN 'PEAK' ELSE 'OFF_PEAK' END AS business_period,
 strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%H:%M') || '-' || strftime(time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE, '%H:%M') AS half_hour_bucket,
 count(*) AS events FROM events GROUP BY ALL""",
    "dim_order_two_loads": """
SELECT e.order_sk, e.order_bk, e.order_state_cd, e.change_hash, DATE '2001-07-01' AS row_eff_dt,
 CASE WHEN h.change_hash <> e.change_hash THEN DATE '2001-07-31' ELSE DATE '9999-12-31' END AS row_exp_dt, CASE WHEN h.change_hash <> e.change_hash THEN 'N' ELSE 'Y' END AS current_row_flag
FROM headers_earlier e JOIN headers h USING (order_bk)
UNION ALL
SELECT (SELECT count(*) FROM headers_earlier) + row_number() OVER (ORDER BY h.order_bk), h.order_bk, h.order_state_cd, h.change_hash, DATE '2001-08-01', DATE '9999-12-31', 'Y'
FROM headers h LEFT JOIN headers_earlier e USING (order_bk) WHERE e.order_bk IS NULL OR e.change_hash <> h.change_hash""",
    "fact_transition": "SELECT * EXCLUDE (hrs), hrs::DOUBLE AS duration_in_from_state_hrs FROM fact_transition",
    "fact_order": f"""SELECT * EXCLUDE (total_order_amount, order_amount_excl_vat, vat_amount, discount_amount, recurring_charge_mrc, one_time_charge_otc, expected_annual_revenue,
 fulfilment_duration_hrs, sla_target_hrs, sla_remaining_hrs), {_d('total_order_amount','order_amount_excl_vat','vat_amount','discount_amount','recurring_charge_mrc','one_time_charge_otc','expected_annual_revenue','fulfilment_duration_hrs','sla_target_hrs','sla_remaining_hrs')} FROM (SELECT f.*, b.order_bk, b.order_date, b.segment_cd FROM fact_order f JOIN fact_base b ON b.order_sk = f.order_sk) q""",
    "daily_equals_full": f"""SELECT * EXCLUDE (total_order_amount, order_amount_excl_vat, vat_amount, discount_amount, recurring_charge_mrc, one_time_charge_otc, expected_annual_revenue,
 fulfilment_duration_hrs, sla_target_hrs, sla_remaining_hrs), {_d('total_order_amount','order_amount_excl_vat','vat_amount','discount_amount','recurring_charge_mrc','one_time_charge_otc','expected_annual_revenue','fulfilment_duration_hrs','sla_target_hrs','sla_remaining_hrs')} FROM (SELECT f.*, b.order_bk, b.order_date, b.segment_cd FROM fact_order f JOIN fact_base b ON b.order_sk = f.order_sk) q""",
    "fact_item": f"""SELECT * EXCLUDE (unit_price_excl_vat, unit_price_incl_vat, item_total_amount, item_discount_amount, item_vat_amount, item_mrc, item_otc, item_sla_target_hrs),
 {_d('unit_price_excl_vat','unit_price_incl_vat','item_total_amount','item_discount_amount','item_vat_amount','item_mrc','item_otc','item_sla_target_hrs')} FROM fact_item""",
    "mart_order_kpi": f"""SELECT * EXCLUDE (gross_order_value, net_order_value, vat_collected, total_mrc, total_otc, total_discount, expected_annual_revenue, max_fulfilment_hrs, total_order_items),
 {_d('gross_order_value','net_order_value','vat_collected','total_mrc','total_otc','total_discount','expected_annual_revenue','max_fulfilment_hrs')}, {_ints('total_order_items')} FROM kpi""",
    "mart_sla_compliance": f"""
SELECT report_period, (year(rd) * 10000 + month(rd) * 100 + 1)::INT AS report_date_sk, rd AS report_date,
 CASE WHEN grouping(t) = 1 THEN 'ALL' ELSE t END AS service_type, CASE WHEN grouping(s) = 1 THEN 'ALL' ELSE s END AS segment_cd,
 CASE WHEN grouping(r) = 1 THEN 'ALL' ELSE r END AS admin_region_cd, grouping(report_period, t, s, r)::BIGINT AS grouping_level,
 CASE WHEN grouping(t) = 0 AND t = 'FIBER' THEN 48.0 WHEN grouping(t) = 0 AND t = '5G' THEN 12.0 ELSE 24.0 END::DOUBLE AS sla_threshold_hrs, count(*) AS total_orders,
 count(*) FILTER (WHERE b = 'N') AS orders_within_sla, count(*) FILTER (WHERE b = 'Y') AS orders_breached_sla,
 {_pct("count(*) FILTER (WHERE b = 'N')", "count(*)")} AS sla_compliance_rate, 95.0::DOUBLE AS target_rate,
 CASE WHEN {_pct("count(*) FILTER (WHERE b = 'N')", "count(*)")} >= 95 THEN 'Y' ELSE 'N' END AS is_compliant,
 sum(h)::DOUBLE / count(h) AS avg_fulfilment_hrs, (percentile_disc(0.95) WITHIN GROUP (ORDER BY h))::DOUBLE AS p95_fulfilment_hrs,
 (percentile_disc(0.99) WITHIN GROUP (ORDER BY h))::DOUBLE AS p99_fulfilment_hrs, max(h)::DOUBLE AS max_fulfilment_hrs,
 count(*) FILTER (WHERE b = 'Y' AND h - tg <= 6) AS breach_0_6hrs, count(*) FILTER (WHERE b = 'Y' AND h - tg > 6 AND h - tg <= 24) AS breach_6_24hrs,
 count(*) FILTER (WHERE b = 'Y' AND h - tg > 24) AS breach_24hrs_plus
FROM (SELECT year_month AS report_period, (year_month || '-01')::DATE AS rd, coalesce(product_type_cd,'UNKNOWN') AS t, coalesce(segment_cd,'UNKNOWN') AS s, coalesce(admin_region_cd,'UNKNOWN') AS r,
   fulfilment_duration_hrs AS h, sla_breach_flag AS b, sla_target_hrs AS tg FROM wide WHERE {_DONE}) q
GROUP BY GROUPING SETS ((report_period, rd, t, s, r), (report_period, rd, t, s), (report_period, rd, t), (report_period, rd))""",
    "mart_adoption": f"""
SELECT date_sk AS report_date_sk, full_date AS report_date, coalesce(admin_region_cd,'UNKNOWN') AS admin_region_cd, admin_region_nm_en, coalesce(segment_cd,'CONSUMER') AS segment_cd,
 product_family_nm, count(*) AS total_orders_all, count(*) FILTER (WHERE technology_tier = '5G') AS orders_5g, count(*) FILTER (WHERE technology_tier = '4G') AS orders_4g,
 count(*) FILTER (WHERE technology_tier = 'FIBER') AS orders_fiber, {_pct("count(*) FILTER (WHERE technology_tier = '5G')", "count(*)")} AS adoption_rate_5g_pct,
 {_pct("count(*) FILTER (WHERE technology_tier = 'FIBER')", "count(*)")} AS adoption_rate_fiber_pct,
 coalesce(sum(total_order_amount) FILTER (WHERE technology_tier = '5G'), 0)::DOUBLE AS revenue_5g, coalesce(sum(total_order_amount) FILTER (WHERE technology_tier = '4G'), 0)::DOUBLE AS revenue_4g,
 sum(total_order_amount) FILTER (WHERE technology_tier = '5G')::DOUBLE / nullif(count(*) FILTER (WHERE technology_tier = '5G'), 0) AS avg_contract_value_5g,
 sum(total_order_amount) FILTER (WHERE technology_tier = '4G')::DOUBLE / nullif(count(*) FILTER (WHERE technology_tier = '4G'), 0) AS avg_contract_value_4g,
 (avg_contract_value_5g - avg_contract_value_4g) / nullif(avg_contract_value_4g, 0) * 100.0 AS acv_uplift_5g_vs_4g_pct,
 {_pct("count(*) FILTER (WHERE has_5g_coverage = 'Y')", "count(*)")} AS pct_orders_in_5g_coverage
FROM wide GROUP BY 1,2,3,4,5,6""",
    "mart_revenue_assurance": f"""
SELECT (year(rd) * 10000 + month(rd) * 100 + 1)::INT AS report_date_sk, rd AS report_date, report_month, segment_cd, product_type_cd, count(*) AS completed_orders,
 sum(e)::DOUBLE AS expected_total_revenue, 0::DOUBLE AS expected_mrc, 0::DOUBLE AS expected_otc, sum(v)::DOUBLE AS expected_vat,
 count(*) FILTER (WHERE b IS NULL) AS orders_no_billing_record, count(*) FILTER (WHERE abs(b - e) > 1) AS orders_billing_mismatch, count(*) FILTER (WHERE b - e > 1) AS orders_overbilled,
 count(*) FILTER (WHERE e - b > 1) AS orders_underbilled, coalesce(sum(e - b) FILTER (WHERE e - b > 1), 0)::DOUBLE AS underbilling_amount,
 coalesce(sum(b - e) FILTER (WHERE b - e > 1), 0)::DOUBLE AS overbilling_amount, coalesce(sum(e) FILTER (WHERE b IS NULL), 0)::DOUBLE AS uncollected_revenue,
 (coalesce(sum(e - b) FILTER (WHERE e - b > 1), 0) + coalesce(sum(e) FILTER (WHERE b IS NULL), 0))::DOUBLE AS total_leakage_amount,
 coalesce(sum(bv), 0)::DOUBLE AS vat_billed, (sum(v) - coalesce(sum(bv), 0))::DOUBLE AS vat_variance,
 {_pct("coalesce(sum(e - b) FILTER (WHERE e - b > 1), 0) + coalesce(sum(e) FILTER (WHERE b IS NULL), 0)", "sum(e)")} AS leakage_rate_pct
FROM (SELECT year_month AS report_month, (year_month || '-01')::DATE AS rd, coalesce(segment_cd,'CONSUMER') AS segment_cd, coalesce(product_type_cd,'UNKNOWN') AS product_type_cd,
  total_order_amount AS e, vat_amount AS v, billed_amount AS b, billed_vat AS bv FROM wide LEFT JOIN billing ON billing.order_id = wide.order_bk WHERE {_DONE}) q
GROUP BY ALL""",
    "vw_exec_order_summary": f"""
SELECT strftime(kpi_date, '%Y-%m') AS report_month, {', '.join(f'sum({a})::BIGINT AS {b}' for a, b in (('total_orders','monthly_orders'),('completed_orders','completed'),('cancelled_orders','cancelled'),('failed_orders','failed'),('digital_orders','digital_orders'),('order_5g_count','orders_5g'),('fallout_orders','fallout_orders')))},
 sum(gross_order_value)::DOUBLE AS gross_revenue, sum(net_order_value)::DOUBLE AS net_revenue, sum(vat_collected)::DOUBLE AS vat, sum(total_discount)::DOUBLE AS discounts,
 round(avg(avg_order_value), 6) AS avg_order_value, sum(gross_order_value)::DOUBLE / sum(total_orders)::DOUBLE AS avg_order_value_weighted,
 {_pct('sum(digital_orders)', 'sum(total_orders)')} AS digital_share_pct, {_pct('sum(order_5g_count)', 'sum(total_orders)')} AS pct_5g_adoption,
 round(avg(sla_compliance_rate_pct), 6) AS avg_sla_compliance_pct, round(avg(fallout_rate_pct), 6) AS avg_fallout_rate_pct FROM kpi GROUP BY 1""",
    "vw_channel_comparison": """
SELECT kpi_date, channel_cd, CASE WHEN digital_orders > 0 THEN 'DIGITAL' ELSE 'PHYSICAL' END AS channel_type, sum(total_orders)::BIGINT AS orders, sum(net_order_value)::DOUBLE AS revenue,
 round(avg(avg_order_value), 6) AS avg_order, round(avg(sla_compliance_rate_pct), 6) AS sla_compliance_pct, round(avg(fallout_rate_pct), 6) AS fallout_rate_pct FROM kpi GROUP BY 1,2,3""",
    "vw_5g_regional_adoption": f"""
SELECT strftime(kpi_date, '%Y-%m') AS report_month, admin_region_cd, sum(total_orders)::BIGINT AS total_orders, sum(order_5g_count)::BIGINT AS orders_5g,
 {_pct('sum(order_5g_count)', 'sum(total_orders)')} AS pct_5g_adoption, sum(gross_order_value)::DOUBLE AS total_revenue,
 coalesce(sum(gross_order_value) FILTER (WHERE is_5g_flag = 'Y'), 0)::DOUBLE AS revenue_5g FROM kpi GROUP BY 1,2""",
    "uc01a_adoption_by_region": f"""
SELECT year_num, month_nm_en, month_num, admin_region_nm_en AS region, admin_region_nm_ar, count(DISTINCT order_sk) AS total_orders,
 count(*) FILTER (WHERE technology_tier = '5G') AS orders_5g, count(*) FILTER (WHERE technology_tier = '4G') AS orders_4g, count(*) FILTER (WHERE technology_tier = 'FIBER') AS orders_fiber,
 {_pct("count(*) FILTER (WHERE technology_tier = '5G')", "count(DISTINCT order_sk)")} AS adoption_rate_5g_pct,
 coalesce(sum(total_order_amount) FILTER (WHERE technology_tier = '5G'), 0)::DOUBLE AS revenue_5g, coalesce(sum(total_order_amount) FILTER (WHERE technology_tier = '4G'), 0)::DOUBLE AS revenue_4g,
 sum(total_order_amount) FILTER (WHERE technology_tier = '5G')::DOUBLE / nullif(count(*) FILTER (WHERE technology_tier = '5G'), 0) AS acv_5g,
 sum(total_order_amount) FILTER (WHERE technology_tier = '4G')::DOUBLE / nullif(count(*) FILTER (WHERE technology_tier = '4G'), 0) AS acv_4g, acv_5g - acv_4g AS acv_5g_premium,
 {_pct("count(*) FILTER (WHERE has_5g_coverage = 'Y')", "count(*)")} AS pct_orders_in_5g_area
FROM wide WHERE year_num IN (2000, 2001) AND {_DONE} GROUP BY 1,2,3,4,5""",
    "uc01b_top_5g_offerings": f"""
SELECT product_offering_name, product_family_nm, contract_duration_months AS contract_months, count(*) AS order_volume, sum(item_total_amount)::DOUBLE AS total_revenue,
 sum(item_total_amount)::DOUBLE / count(*) AS avg_item_value, sum(item_mrc)::DOUBLE AS total_mrc, sum(item_mrc * contract_duration_months)::DOUBLE AS expected_contract_value,
 rank() OVER (ORDER BY sum(item_total_amount) DESC) AS revenue_rank
FROM fact_item f JOIN {_CUR_P} p ON p.product_offering_sk = f.product_offering_sk AND p.is_5g_flag = 'Y' JOIN dim_date d ON d.date_sk = f.date_sk AND d.year_num = 2000
GROUP BY 1,2,3 ORDER BY sum(item_total_amount) DESC, 1, 2, 3 LIMIT 10""",
    "uc02a_weekly_sla": f"""
SELECT year_num, week_of_year AS iso_week, channel_cd, coalesce(segment_cd,'CONSUMER') AS segment,
 CASE product_type_cd WHEN 'FIBER' THEN 48.0 WHEN '5G' THEN 12.0 ELSE 24.0 END::DOUBLE AS sla_hrs, count(DISTINCT order_sk) AS completed_orders,
 count(*) FILTER (WHERE sla_breach_flag = 'N') AS within_sla, count(*) FILTER (WHERE sla_breach_flag = 'Y') AS breached_sla,
 {_pct("count(*) FILTER (WHERE sla_breach_flag = 'N')", "count(DISTINCT order_sk)")} AS sla_compliance_pct,
 CASE WHEN {_pct("count(*) FILTER (WHERE sla_breach_flag = 'N')", "count(DISTINCT order_sk)")} >= 95 THEN 'CITC COMPLIANT' ELSE 'CITC NON-COMPLIANT' END AS sla_status,
 sum(fulfilment_duration_hrs)::DOUBLE / count(fulfilment_duration_hrs) AS avg_fulfilment_hrs,
 (percentile_disc(0.95) WITHIN GROUP (ORDER BY fulfilment_duration_hrs))::DOUBLE AS p95_fulfilment_hrs, max(fulfilment_duration_hrs)::DOUBLE AS max_fulfilment_hrs
FROM wide WHERE {_DONE} AND full_date >= DATE '2001-08-01' - 90 GROUP BY 1,2,3,4,5""",
    "uc02b_bottlenecks": """
SELECT s1.order_state_cd AS from_state, s2.order_state_cd AS to_state, count(*) AS transition_count, sum(hrs)::DOUBLE / count(*) AS avg_hrs_in_state,
 (percentile_disc(0.95) WITHIN GROUP (ORDER BY hrs))::DOUBLE AS p95_hrs_in_state, max(hrs)::DOUBLE AS max_hrs_in_state,
 count(*) FILTER (WHERE is_sla_critical_state = 'Y') AS on_sla_critical_path, rank() OVER (ORDER BY sum(hrs)::DOUBLE / count(*) DESC) AS bottleneck_rank,
 count(*)::DOUBLE * (sum(hrs)::DOUBLE / count(*)) AS time_impact_score
FROM fact_transition t JOIN dim_state s1 ON s1.order_state_sk = from_state_sk JOIN dim_state s2 ON s2.order_state_sk = to_state_sk
JOIN dim_date d ON d.date_sk = transition_date_sk AND d.full_date >= DATE '2024-01-31' - 30 WHERE hrs > 0 GROUP BY 1,2""",
    "uc03a_revenue_vat": f"""
SELECT year_month AS report_month, coalesce(segment_cd,'CONSUMER') AS segment, count(*) FILTER (WHERE {_DONE}) AS completed_orders,
 coalesce(sum(total_order_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS expected_gross_revenue, coalesce(sum(order_amount_excl_vat) FILTER (WHERE {_DONE}), 0)::DOUBLE AS expected_net_revenue,
 coalesce(sum(vat_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS expected_vat, coalesce(sum(discount_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS total_discounts,
 0::DOUBLE AS expected_annual_mrc, 0::BIGINT AS orders_with_billing_issues,
 round(avg(CASE WHEN order_amount_excl_vat > 0 THEN vat_amount::DOUBLE / order_amount_excl_vat::DOUBLE * 100.0 END), 6) AS effective_vat_rate_pct,
 count(*) FILTER (WHERE order_amount_excl_vat > 0 AND abs(vat_amount::DOUBLE / order_amount_excl_vat::DOUBLE * 100.0 - 15.0) > 0.01) AS vat_deviation_count
FROM wide WHERE year_num = 2000 GROUP BY 1,2""",
    "uc04_channel_performance": f"""
SELECT year_num, month_num, month_nm_en, channel_cd, channel_type_cd, is_digital_flag, medium_cd, count(DISTINCT order_sk) AS total_orders, sum(total_order_amount)::DOUBLE AS gross_revenue,
 sum(total_order_amount)::DOUBLE / count(*) AS avg_order_value, count(DISTINCT customer_sk) AS unique_customers, count(*) FILTER (WHERE is_new_customer_order = 'Y') AS new_acquisitions,
 {_pct(f"count(*) FILTER (WHERE {_DONE})", "count(DISTINCT order_sk)")} AS completion_rate_pct, {_pct("count(*) FILTER (WHERE fallout_flag = 'Y')", "count(DISTINCT order_sk)")} AS fallout_rate_pct,
 sum(fulfilment_duration_hrs)::DOUBLE / count(fulfilment_duration_hrs) AS avg_fulfilment_hrs,
 {_pct("count(DISTINCT order_sk)", "sum(count(DISTINCT order_sk)) OVER (PARTITION BY year_num, month_num)")} AS channel_market_share_pct,
 {_pct("count(*) FILTER (WHERE is_digital_flag = 'Y')", "sum(count(DISTINCT order_sk)) OVER (PARTITION BY year_num, month_num)")} AS digital_share_of_total_pct
FROM wide WHERE year_num = 2000 GROUP BY 1,2,3,4,5,6,7""",
    "uc05_customer_history": f"""
SELECT c.customer_bk, c.customer_type_cd, c.customer_segment_cd, c.city_nm, c.region_nm, c.activation_dt AS customer_since, c.churn_risk_score::DOUBLE AS churn_risk_score,
 full_date AS order_date, order_bk AS order_id, w.order_category_cd AS order_type, order_state_cd AS current_state, channel_cd AS order_channel, product_offering_name, product_type_cd,
 technology_tier, total_order_amount::DOUBLE AS order_value, 0::DOUBLE AS monthly_charge, discount_amount::DOUBLE AS discount_amount, fulfilment_duration_hrs::DOUBLE AS fulfilment_duration_hrs,
 sla_breach_flag, order_item_count, (sum(total_order_amount) OVER (PARTITION BY w.customer_sk ORDER BY full_date, order_bk ROWS UNBOUNDED PRECEDING))::DOUBLE AS cumulative_spend,
 count(*) OVER (PARTITION BY w.customer_sk) AS total_lifetime_orders, row_number() OVER (PARTITION BY w.customer_sk ORDER BY full_date, order_bk) AS order_sequence_num
FROM wide w JOIN {_CUR_C} c ON c.customer_sk = w.customer_sk""",
    "uc06_fallout_root_cause": f"""
SELECT change_reason_cd AS failure_reason, change_reason_desc, s1.order_state_cd AS failed_at_state, channel_cd, admin_region_nm_en AS region, product_type_cd, count(*) AS fallout_count,
 {_pct("count(*)", "sum(count(*)) OVER (PARTITION BY change_reason_cd)")} AS pct_of_reason, sum(hrs)::DOUBLE / count(*) AS avg_time_before_fallout,
 sum(total_order_amount)::DOUBLE AS lost_revenue_estimate, sum(total_order_amount)::DOUBLE / count(*) AS avg_lost_order_value
FROM fact_transition t JOIN wide w ON w.order_sk = t.order_sk JOIN dim_state s1 ON s1.order_state_sk = from_state_sk
JOIN dim_state s2 ON s2.order_state_sk = to_state_sk AND s2.order_state_cd IN ('failed','cancelled','rejected')
JOIN dim_date d ON d.date_sk = transition_date_sk AND d.full_date >= DATE '2024-01-31' - 30 WHERE change_reason_cd IS NOT NULL
GROUP BY 1,2,3,4,5,6 HAVING count(*) >= 5""",
    "uc07_product_mix": f"""
SELECT product_family_nm, product_type_cd, is_bundle_flag, is_5g_flag, contract_duration_months, admin_region_nm_en AS region, customer_segment_cd, year_num, month_num,
 count(*) AS units_ordered, sum(item_total_amount)::DOUBLE AS gross_revenue, sum(item_mrc)::DOUBLE AS total_mrc, sum(item_otc)::DOUBLE AS total_otc,
 sum(item_total_amount)::DOUBLE / count(*) AS avg_item_value, sum(item_mrc)::DOUBLE / count(*) AS avg_mrc, sum(item_discount_amount)::DOUBLE AS total_discounts,
 {_pct('sum(item_discount_amount)', 'sum(item_total_amount)')} AS discount_depth_pct, sum(item_mrc * coalesce(contract_months, 12))::DOUBLE AS total_contract_value,
 sum(item_mrc * coalesce(contract_months, 12))::DOUBLE / count(*) AS avg_contract_value
FROM fact_item f JOIN {_CUR_P} p ON p.product_offering_sk = f.product_offering_sk JOIN dim_date d ON d.date_sk = f.date_sk
LEFT JOIN dim_geography g ON g.geography_sk = f.geography_sk LEFT JOIN {_CUR_C} c ON c.customer_sk = f.customer_sk
JOIN dim_state s ON s.order_state_sk = f.item_state_sk AND s.order_state_cd = 'completed' WHERE year_num = 2000 GROUP BY 1,2,3,4,5,6,7,8,9""",
    "uc08_agent_scorecard": f"""
SELECT agent_id, agent_store_cd, party_name AS agent_name, admin_region_nm_en AS region, year_num, month_num, count(DISTINCT order_sk) AS orders_handled,
 sum(total_order_amount)::DOUBLE AS revenue_generated, sum(total_order_amount)::DOUBLE / count(*) AS avg_order_value, {_pct(f"count(*) FILTER (WHERE {_DONE})", "count(*)")} AS completion_rate_pct,
 {_pct(f"count(*) FILTER (WHERE {_DONE} AND sla_breach_flag = 'N')", f"count(*) FILTER (WHERE {_DONE})")} AS sla_compliance_pct, count(*) FILTER (WHERE fallout_flag = 'Y') AS fallout_count,
 {_pct("count(*) FILTER (WHERE fallout_flag = 'Y')", "count(*)")} AS fallout_rate_pct, count(*) FILTER (WHERE is_new_customer_order = 'Y') AS new_acquisitions,
 rank() OVER (PARTITION BY admin_region_nm_en, year_num, month_num ORDER BY sum(total_order_amount) DESC) AS region_revenue_rank
FROM wide w JOIN dim_party p ON p.party_sk = w.seller_party_sk AND party_role_cd = 'seller' AND agent_id IS NOT NULL WHERE year_num = 2000 AND month_num = 6 GROUP BY 1,2,3,4,5,6""",
    "uc09_cohort_funnel": f"""
SELECT order_state_cd, sort_order, count(DISTINCT t.order_sk) AS orders_reached_state,
 {_pct("count(DISTINCT t.order_sk)", "(SELECT count(*) FROM fact_order WHERE date_sk BETWEEN 19980301 AND 19980331)")} AS pct_of_cohort,
 (SELECT count(*) FROM fact_order WHERE date_sk BETWEEN 19980301 AND 19980331) - count(DISTINCT t.order_sk) AS dropped_before_state
FROM fact_transition t JOIN dim_state s ON s.order_state_sk = to_state_sk WHERE t.order_sk IN (SELECT order_sk FROM fact_order WHERE date_sk BETWEEN 19980301 AND 19980331) GROUP BY 1,2""",
    "uc10_vat_reconciliation": f"""
SELECT year_month AS tax_period, hijri_month_nm_ar AS hijri_period, seg AS segment, grouping(year_month, hijri_month_nm_ar, seg)::BIGINT AS grouping_level,
 count(DISTINCT order_sk) AS total_taxable_transactions, count(*) FILTER (WHERE {_DONE}) AS completed_transactions, count(*) FILTER (WHERE order_state_cd = 'cancelled') AS cancelled_transactions,
 coalesce(sum(order_amount_excl_vat) FILTER (WHERE {_DONE}), 0)::DOUBLE AS net_taxable_revenue, coalesce(sum(vat_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS vat_output,
 coalesce(sum(order_amount_excl_vat * 0.15::DECIMAL(3,2)) FILTER (WHERE {_DONE}), 0)::DOUBLE AS vat_recomputed,
 abs(coalesce(sum(vat_amount) FILTER (WHERE {_DONE}), 0) - coalesce(sum(order_amount_excl_vat * 0.15::DECIMAL(3,2)) FILTER (WHERE {_DONE}), 0))::DOUBLE AS vat_variance,
 coalesce(sum(total_order_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS gross_revenue_incl_vat, coalesce(sum(discount_amount) FILTER (WHERE {_DONE}), 0)::DOUBLE AS discounts_given,
 coalesce(sum(discount_amount * 0.15::DECIMAL(3,2)) FILTER (WHERE {_DONE}), 0)::DOUBLE AS vat_on_discounts
FROM (SELECT *, coalesce(segment_cd,'CONSUMER') AS seg FROM wide WHERE year_num = 2000) w GROUP BY ROLLUP (year_month, hijri_month_nm_ar, seg)""",
    "vw_order_pulse": """
SELECT order_state_cd, channel_cd, coalesce(segment_cd,'CONSUMER') AS segment, count(*) AS orders_count, sum(total_order_amount)::DOUBLE AS revenue,
 sum(total_order_amount)::DOUBLE / count(*) AS avg_order, count(*) FILTER (WHERE sla_breach_flag = 'Y') AS sla_breaches FROM wide WHERE full_date = DATE '2001-07-20' GROUP BY 1,2,3""",
    "vw_stuck_orders": """
SELECT order_bk AS order_id, order_date, order_state_cd AS current_state, channel_cd, coalesce(segment_cd,'CONSUMER') AS segment, total_order_amount::DOUBLE AS order_value,
 sla_target_hrs::DOUBLE AS sla_target_hrs, sla_remaining_hrs::DOUBLE AS sla_remaining_hrs,
 CASE WHEN sla_remaining_hrs < 0 THEN 'BREACHED' WHEN sla_remaining_hrs < 2 THEN 'AT_RISK' ELSE 'OK' END AS sla_status, date_sub('hour', order_date, TIMESTAMP '2001-08-01 12:00:00') AS age_hours
FROM wide WHERE is_terminal_state = 'N' AND full_date >= DATE '2001-08-01' - 7 AND date_sub('hour', order_date, TIMESTAMP '2001-08-01 12:00:00') > 24""",
    "staging_marked_processed": "SELECT stg_record_id, order_id, CASE WHEN final_status = 'V' THEN 'P' ELSE final_status END AS stg_record_status FROM checked_orders",
    "staging_after_purge": "SELECT order_id, stg_record_id FROM stg_orders WHERE try_cast(order_date AS TIMESTAMP) IS NULL OR try_cast(order_date AS TIMESTAMP)::DATE >= DATE '2001-08-01' - 90",
    "staging_after_load_purge": "SELECT order_id, stg_record_id, (DATE '2001-08-01' - ((stg_record_id % 8) * 30)::INT) AS load_date FROM stg_orders WHERE (stg_record_id % 8) * 30 <= 90",
    "scd2_touched_buckets": f"SELECT * EXCLUDE (churn_risk_score), {_d('churn_risk_score')} FROM dim_customer WHERE customer_sk <> -1",
    "approximate_customers": """
SELECT (date_sk // 100)::INT AS month_sk, channel_sk, count(DISTINCT customer_sk) AS customers, TRUE AS close FROM fact_order GROUP BY 1, 2""",
    "percentiles_from_counts": """
SELECT channel_sk, geography_sk, grouping(channel_sk, geography_sk)::BIGINT AS grouping_level, (percentile_disc(0.5) WITHIN GROUP (ORDER BY fulfilment_duration_hrs))::DOUBLE AS p50,
 (percentile_disc(0.95) WITHIN GROUP (ORDER BY fulfilment_duration_hrs))::DOUBLE AS p95, (percentile_disc(0.99) WITHIN GROUP (ORDER BY fulfilment_duration_hrs))::DOUBLE AS p99
FROM fact_order WHERE fulfilment_duration_hrs IS NOT NULL GROUP BY ROLLUP (channel_sk, geography_sk)""",
    "seed_states_in_use": """
SELECT s.*, coalesce(n, 0) AS fact_rows FROM (VALUES
 (1, 'acknowledged', 'Acknowledged', 'مقبول', 'ACTIVE', 'N', 'Y', 'N', 1, '#1E88E5'), (2, 'rejected', 'Rejected', 'مرفوض', 'TERMINAL', 'Y', 'N', 'N', 9, '#E53935'),
 (3, 'pending', 'Pending', 'معلق', 'PAUSED', 'N', 'N', 'N', 3, '#FB8C00'), (4, 'held', 'Held', 'محتجز', 'PAUSED', 'N', 'N', 'N', 4, '#F4511E'),
 (5, 'inProgress', 'In Progress', 'قيد التنفيذ', 'ACTIVE', 'N', 'Y', 'N', 5, '#43A047'), (6, 'cancelled', 'Cancelled', 'ملغى', 'TERMINAL', 'Y', 'N', 'N', 7, '#757575'),
 (7, 'completed', 'Completed', 'مكتمل', 'TERMINAL', 'Y', 'N', 'Y', 6, '#00897B'), (8, 'failed', 'Failed', 'فشل', 'TERMINAL', 'Y', 'N', 'N', 8, '#C62828'),
 (9, 'partial', 'Partial', 'جزئي', 'TERMINAL', 'Y', 'N', 'Y', 6, '#558B2F'), (-1, 'UNKNOWN', 'Unknown', 'غير معروف', 'ACTIVE', 'N', 'N', 'N', 99, '#9E9E9E'))
 s(order_state_sk, order_state_cd, order_state_nm, order_state_nm_ar, state_category, is_terminal_state, is_sla_clock_running, is_billable_state, sort_order, state_color_hex)
LEFT JOIN (SELECT order_state_sk, count(*) AS n FROM fact_order GROUP BY 1) f USING (order_state_sk)""",
    "seed_channels_in_use": """
SELECT s.*, coalesce(n, 0) AS fact_rows FROM (VALUES
 (1, 'DIGITAL_APP', 'DIGITAL', 'STC App', 'تطبيق STC', 'MOBILE_APP', 'Y', 'Y', 'DIGITAL'), (2, 'DIGITAL_WEB', 'DIGITAL', 'STC Web Portal', 'البوابة الإلكترونية', 'WEB', 'Y', 'Y', 'DIGITAL'),
 (3, 'RETAIL', 'PHYSICAL', 'Retail Store', 'متجر التجزئة', 'IN_STORE', 'N', 'N', 'DIRECT'), (4, 'TELESALES', 'ASSISTED', 'Telesales', 'المبيعات الهاتفية', 'IVRS', 'N', 'N', 'DIRECT'),
 (5, 'B2B_PORTAL', 'DIGITAL', 'B2B Portal', 'بوابة الأعمال', 'WEB', 'Y', 'Y', 'DIGITAL'), (6, 'PARTNER', 'INDIRECT', 'Partner/MVNO', 'الشريك', 'API', 'N', 'N', 'INDIRECT'),
 (-1, 'UNKNOWN', 'UNKNOWN', 'Unknown', 'غير معروف', 'UNKNOWN', 'N', 'N', 'UNKNOWN'))
 s(channel_sk, channel_cd, channel_type_cd, channel_nm_en, channel_nm_ar, medium_cd, is_digital_flag, is_self_service, channel_group)
LEFT JOIN (SELECT channel_sk, count(*) AS n FROM fact_order GROUP BY 1) f USING (channel_sk)""",
    "seed_actions_in_use": """
SELECT s.*, coalesce(n, 0) AS fact_rows FROM (VALUES
 (1, 'add', 'Add (New Product)', 'إضافة', 'Y'), (2, 'modify', 'Modify (Upgrade)', 'تعديل', 'Y'), (3, 'delete', 'Delete (Terminate)', 'حذف', 'N'),
 (4, 'noChange', 'No Change (Unchanged)', 'بدون تغيير', 'N'), (-1, 'UNKNOWN', 'Unknown', 'غير معروف', 'N'))
 s(action_sk, action_cd, action_nm, action_nm_ar, is_revenue_generating)
LEFT JOIN (SELECT action_sk, count(*) AS n FROM fact_item GROUP BY 1) f USING (action_sk)""",
    "daily_batch_staging": "SELECT stg_record_id, order_id, CASE WHEN final_status = 'V' THEN 'P' ELSE final_status END AS stg_record_status FROM checked_orders",
    "daily_batch_errors": f"""
SELECT '{BATCH}' AS err_batch_id, e.code AS err_rule_code, 'stg_product_order' AS err_source_table, e.order_id, e.item AS order_item_id, total_amount, NULL AS price_amount, customer_id, NULL AS national_id
FROM order_errors_of e
UNION ALL SELECT '{BATCH}', e.code, 'stg_product_order_item', e.order_id, e.item, NULL, i.price_amount, NULL, NULL FROM item_errors e JOIN stg_items i ON i.order_id = e.order_id AND i.order_item_id = e.item
UNION ALL SELECT '{BATCH}', 'DQ-09', 'stg_customer', NULL, NULL, NULL, NULL, customer_id, NULL FROM stg_customers_2
 WHERE national_id <> '' AND NOT regexp_matches(trim(national_id), '^[12][0-9]{{9}}$')""",
    "daily_batch_halted": f"""
SELECT stg_batch_id AS batch_id, count(*) AS total_records, count(*) FILTER (WHERE final_status = 'V') AS valid_records, 'FAIL - BATCH HALTED' AS dq_verdict, TRUE AS halted,
 'stage,check,log' AS steps_finished, 0::BIGINT AS new_versions, FALSE AS fact_loaded FROM checked_orders GROUP BY 1""",
    "daily_batch_ledger": f"""
SELECT '{BATCH}' AS batch_id, step, position, table_name, CASE table_name WHEN 'stg_orders' THEN (SELECT count(*) FROM stg_orders) WHEN 'stg_items' THEN (SELECT count(*) FROM stg_items)
  WHEN 'stg_events' THEN (SELECT count(*) FROM stg_events) WHEN 'ods_orders' THEN (SELECT count(*) FROM ods_orders) WHEN 'ods_items' THEN (SELECT count(*) FROM ods_items)
  WHEN 'fact_transition' THEN (SELECT count(*) FROM fact_transition) WHEN 'fact_order' THEN (SELECT count(*) FROM fact_order) WHEN 'fact_item' THEN (SELECT count(*) FROM fact_item) END AS rows
FROM (VALUES ('stage', 1, 'stg_orders'), ('stage', 1, 'stg_items'), ('stage', 1, 'stg_events'), ('check', 2, 'stg_orders'), ('check', 2, 'stg_items'), ('log', 3, NULL), ('judge', 4, NULL),
 ('dimensions', 5, NULL), ('cleanse', 6, 'ods_orders'), ('cleanse', 6, 'ods_items'), ('headers', 7, NULL), ('transitions', 8, 'fact_transition'), ('orders', 9, 'fact_order'),
 ('items', 10, 'fact_item'), ('mark', 11, 'stg_orders'), ('mark', 11, 'stg_items')) t(step, position, table_name)""",
}
FINAL["uc06_bucketed"] = FINAL["uc06_fallout_root_cause"]
FINAL["uc09_bucketed"] = FINAL["uc09_cohort_funnel"]
FINAL["order_customer_merged"] = FINAL["order_customer_as_recorded"]
FINAL["mart_sales_as_recorded"] = """
SELECT strftime(o.order_date, '%Y-%m') AS year_month, coalesce(c.customer_segment_cd, 'UNKNOWN') AS segment, count(*) AS orders, sum(o.total_order_amount)::DOUBLE AS revenue
FROM ods_orders o LEFT JOIN (SELECT * FROM dim_customer WHERE customer_sk > 0) c
 ON c.customer_bk = o.customer_bk AND greatest(o.order_date::DATE, DATE '2001-07-01') BETWEEN c.row_eff_dt AND c.row_exp_dt GROUP BY 1, 2"""
FINAL["daily_batch_resumed"] = FINAL["daily_equals_full"]
FINAL["daily_batch_items"] = FINAL["fact_item"]


def order_sql() -> dict[str, str]:
    return {name: compose(STEPS, sql) for name, sql in FINAL.items()}
