"""SQL for the views of views.py, shared by all checks. Written separately from the Spark expressions."""

TARGETS = "('ECONOMY', 'STANDARD', 'PROMO')"

# base tables under ride names
VIEWS = """
ve AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || lpad(CAST(l_partkey AS VARCHAR), 10, '0')
         || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || CAST(l_linenumber AS VARCHAR) AS "RideEstimativeID",
         l_orderkey AS "RideID", l_partkey AS "ProductID",
         CASE WHEN l_partkey % 997 = 0 THEN 0.0 ELSE l_extendedprice END AS "Price",
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS "WaitingTime",
         CASE l_returnflag WHEN 'R' THEN NULL WHEN 'N' THEN ' ' ELSE l_linestatus END AS "FareID",
         l_tax AS "Fee", l_shipdate AS "Updated", CAST(l_linenumber AS BIGINT) AS "LineNo",
         l_suppkey AS "SupplierID",
         CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_discount END AS "OriginLat", l_tax AS "DestinationLat"
  FROM lineitem),
vr AS (
  SELECT o_orderkey AS "RideID", o_custkey AS "UserID",
         o_orderdate - to_seconds(CAST(o_orderkey % 400 AS INTEGER)) AS "Schedule", o_orderdate AS "Create",
         CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice END AS "RidePrice",
         o_orderstatus AS "RideStatus",
         CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(1 AS BIGINT) END AS "ScheduledRide"
  FROM orders),
vru AS (SELECT vr.*, "Updated" FROM vr LEFT JOIN (SELECT "RideID", max("Updated") AS "Updated" FROM ve GROUP BY 1) USING ("RideID")),
vp AS (SELECT p_partkey AS "ProductID", p_type AS "CategoryID", p_name AS "ProductDescription" FROM part),
vad AS (
  SELECT l_orderkey AS "RideID", CAST(l_linenumber AS BIGINT) AS "RideAddressTypeID", min(l_suppkey) AS "AddressID"
  FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1, 2),
vk AS (
  SELECT event_id AS "RideID", user_id AS "UserID", ts AS "Create", event_type AS "CategoryID", value AS "Price",
         ts - to_seconds(CAST(event_id % 400 AS INTEGER)) AS "Schedule"
  FROM events),
va AS (
  SELECT ve.*, "UserID", "Schedule", "Create", "RidePrice", "RideStatus", "ScheduledRide", "CategoryID",
         "ProductDescription"
  FROM ve LEFT JOIN vr USING ("RideID") LEFT JOIN vp USING ("ProductID"))"""

# cleaning
CURATED = """
vm AS (SELECT quantile_cont("WaitingTime", 0.5) AS wmed, quantile_cont("WaitingTime", 0.99) AS wcap,
              quantile_cont("Fee", 0.5) AS fmed FROM va WHERE "Price" > 0),
vcap AS (SELECT "CategoryID", quantile_cont("Price", 0.995) AS "Price_cap" FROM va WHERE "Price" > 0 GROUP BY 1),
vs0 AS (
  SELECT *, "Create" IS NULL OR "Schedule" IS NULL AS bad_time,
         coalesce("Updated" < "Create", false) AS bad_updated,
         coalesce(coalesce("ScheduledRide", 0) = 0
                  AND abs(epoch_us("Create") - epoch_us("Schedule")) > 300000000, false) AS bad_gap
  FROM (SELECT *, row_number() OVER (PARTITION BY "RideID", "LineNo"
                                     ORDER BY "RideEstimativeID", "Price", "Updated") AS rn FROM va) WHERE rn = 1),
vs AS (
  SELECT *, CASE WHEN bad_time OR bad_updated OR bad_gap THEN 'chronology'
                 WHEN "OriginLat" IS NULL OR "DestinationLat" IS NULL THEN 'missing_coordinate'
                 WHEN "Price" <= 0 THEN 'nonpositive_price' END AS removed_by
  FROM vs0),
vcr AS (SELECT * FROM vs WHERE removed_by IS NULL),
vc AS (
  SELECT vcr.* REPLACE (
           CASE WHEN vcr."Price" > "Price_cap" THEN "Price_cap" ELSE vcr."Price" END AS "Price",
           CASE WHEN coalesce(vcr."WaitingTime", wmed) > wcap THEN wcap
                ELSE coalesce(vcr."WaitingTime", wmed) END AS "WaitingTime",
           coalesce(vcr."Fee", fmed) AS "Fee",
           CASE WHEN "FareID" IS NULL OR trim("FareID") = '' THEN 'MISSING_FAREID' ELSE "FareID" END AS "FareID"),
         "FareID" IS NULL OR trim("FareID") = '' AS "FareIDWasImputed",
         vcr."WaitingTime" IS NULL AS "WaitingTimeWasImputed", vcr."Fee" IS NULL AS "FeeWasImputed",
         coalesce(coalesce(vcr."WaitingTime", wmed) > wcap, false) AS "WaitingTimeWasCapped",
         coalesce(vcr."Price" > "Price_cap", false) AS "PriceWasCapped"
  FROM vcr CROSS JOIN vm LEFT JOIN vcap USING ("CategoryID"))"""

# cross prices and user history on curated rows
FEATURES = f"""
xp AS (
  SELECT "RideID", arg_min("Price", "RideEstimativeID") FILTER (WHERE "CategoryID" = 'ECONOMY') AS "Price_ECONOMY",
         arg_min("Price", "RideEstimativeID") FILTER (WHERE "CategoryID" = 'STANDARD') AS "Price_STANDARD",
         arg_min("Price", "RideEstimativeID") FILTER (WHERE "CategoryID" = 'PROMO') AS "Price_PROMO"
  FROM vc WHERE "CategoryID" IN {TARGETS} GROUP BY 1),
rb AS (SELECT DISTINCT "RideID", "UserID", "Create", "RidePrice" FROM vc),
rh AS (
  SELECT *, row_number() OVER (PARTITION BY "UserID" ORDER BY "Create", "RideID") - 1 AS "UserPriorRideCount",
         avg(CASE WHEN "RidePrice" > 0 THEN "RidePrice" END) OVER (
           PARTITION BY "UserID" ORDER BY "Create", "RideID" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           AS "UserPriorPaidPriceMean"
  FROM rb),
cb AS (
  SELECT * FROM (SELECT "RideID", "CategoryID", "UserID", "Create", "RideEstimativeID", "Price",
                        row_number() OVER (PARTITION BY "RideID", "CategoryID" ORDER BY "RideEstimativeID") AS rn2
                 FROM vc) WHERE rn2 = 1),
ch AS (
  SELECT *, row_number() OVER cw - 1 AS "UserPriorCategoryRideCount",
         sum("Price") OVER (cw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           / nullif(row_number() OVER cw - 1, 0) AS "UserPriorCategoryPriceMean"
  FROM cb WINDOW cw AS (PARTITION BY "UserID", "CategoryID" ORDER BY "Create", "RideID", "RideEstimativeID")),
vx AS (
  SELECT vc.*, "Price_ECONOMY", "Price_STANDARD", "Price_PROMO", "UserPriorRideCount", "UserPriorPaidPriceMean",
         "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean"
  FROM vc LEFT JOIN xp USING ("RideID")
  LEFT JOIN (SELECT "RideID", "UserPriorRideCount", "UserPriorPaidPriceMean" FROM rh) USING ("RideID")
  LEFT JOIN (SELECT "RideID", "CategoryID", "UserPriorCategoryRideCount", "UserPriorCategoryPriceMean" FROM ch)
    USING ("RideID", "CategoryID"))"""

# time folds: 28-day tests and holdout, 7-day gaps, on positions of observed dates
FOLDS = f"""
vf AS (SELECT "RideEstimativeID", "RideID", "CategoryID", "Create", CAST("Create" AS DATE) AS "CreateDate"
       FROM vcr WHERE "Create" >= TIMESTAMP '1999-01-01'),
fd AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS n
       FROM (SELECT DISTINCT "CreateDate" AS day FROM vf)),
fp AS (SELECT n - 35 AS pool, n FROM fd LIMIT 1),
fw0 AS (
  SELECT 'fold_' || k AS split_name, 'cv' AS split_type, k AS number,
         pool - (4 - k + 1) * 28 AS e0, pool - (4 - k + 1) * 28 + 27 AS e1
  FROM fp, (SELECT unnest([1, 2, 3, 4]) AS k)
  UNION ALL SELECT 'holdout_test', 'holdout', 5, n - 28, n - 1 FROM fp),
fw AS (
  SELECT split_name, split_type, number,
         min(day) FILTER (WHERE pos < e0 - 7) AS train_start, max(day) FILTER (WHERE pos < e0 - 7) AS train_end,
         min(day) FILTER (WHERE pos BETWEEN e0 - 7 AND e0 - 1) AS gap_start,
         max(day) FILTER (WHERE pos BETWEEN e0 - 7 AND e0 - 1) AS gap_end,
         min(day) FILTER (WHERE pos BETWEEN e0 AND e1) AS evaluation_start,
         max(day) FILTER (WHERE pos BETWEEN e0 AND e1) AS evaluation_end
  FROM fw0, fd GROUP BY ALL),
fa AS (
  SELECT vf.*, fw.*, CASE WHEN "CreateDate" BETWEEN train_start AND train_end THEN 'train'
                          WHEN "CreateDate" BETWEEN gap_start AND gap_end THEN 'gap'
                          WHEN "CreateDate" BETWEEN evaluation_start AND evaluation_end THEN 'eval' END AS role
  FROM vf, fw)"""

BASE = ",".join([VIEWS, CURATED, FEATURES, FOLDS]).strip()
