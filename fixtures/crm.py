"""Raw CRM tables made from the driver's tables, as in section 4 of FIXTURES.md.

The text is valid in Spark SQL and in DuckDB, so that it serves the queries and their
oracles alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ankenmart.sources.raw import Source, conform, raw_table

MAPPING: dict[str, str] = {
    "account": """
        SELECT concat('001', lpad(cast(c_custkey AS string), 15, '0')) AS Id, c_name AS Name,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS Type,
          concat('012', lpad(cast(c_custkey % 5 AS string), 15, '0')) AS RecordTypeId,
          CASE WHEN c_custkey % 10 <> 0 THEN concat('001', lpad(cast(c_custkey - c_custkey % 10 AS string), 15, '0')) END AS ParentId,
          concat(n_name, '-city-', cast(c_custkey % 3 AS string)) AS BillingCity, n_name AS BillingState,
          lpad(cast(c_custkey % 1000 AS string), 7, '0') AS BillingPostalCode, r_name AS BillingCountry,
          concat(n_name, '-city-', cast(c_custkey % 4 AS string)) AS ShippingCity, n_name AS ShippingState,
          lpad(cast(c_custkey % 999 AS string), 7, '0') AS ShippingPostalCode, r_name AS ShippingCountry,
          CASE WHEN c_custkey % 31 = 30 THEN NULL ELSE c_custkey % 29 = 28 END AS IsDeleted
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "asset": """
        SELECT concat('02i', lpad(cast(p_partkey AS string), 15, '0')) AS Id, concat('asset-', p_name) AS Name, concat('001', lpad(cast(p_partkey % 150 AS string), 15, '0')) AS AccountId,
          concat('SN', cast(p_partkey AS string)) AS SerialNumber, CASE WHEN p_size > 25 THEN 'Installed' ELSE 'Registered' END AS Status,
          p_brand AS ProductCode, p_type AS ProductFamily, p_name AS ProductName__c,
          DATE '2021-04-01' AS InstallDate, DATE '2020-10-01' AS ManufactureDate, DATE '2021-01-15' AS PurchaseDate,
          CASE WHEN p_size = 50 THEN DATE '2024-03-31' END AS UsageEndDate, p_size % 9 = 0 AS IsCompetitorProduct,
          (SELECT min(o_orderdate) FROM orders) + INTERVAL 9497 DAY AS CreatedDate, (SELECT min(o_orderdate) FROM orders) + INTERVAL 10497 DAY AS LastModifiedDate,
          p_partkey % 41 = 40 AS IsDeleted
        FROM part
    """,
    "building__c": """
        SELECT concat('a0B', lpad(cast(s_suppkey AS string), 15, '0')) AS Id, concat('bldg-', s_name) AS Name, concat('BC', cast(s_suppkey AS string)) AS BuildingControlNumber__c,
          cast(s_suppkey % 40 AS double) + 0.6 AS NumberOfFloors__c, cast(s_suppkey % 12 AS double) AS TotalNumberUnits__c,
          CASE WHEN s_suppkey % 11 <> 0 THEN r_name END AS AddressState__c,
          CASE WHEN s_suppkey % 5 <> 0 THEN concat(cast(s_suppkey AS string), ' Main St') END AS BuildingAddress__Street__s,
          CASE WHEN s_suppkey % 3 <> 0 THEN n_name END AS BuildingAddress__City__s,
          lpad(cast(s_suppkey AS string), 7, '0') AS BuildingAddress__PostalCode__s, cast(n_regionkey AS string) AS BuildingAddress__StateCode__s,
          'JP' AS BuildingAddress__CountryCode__s, cast(30 + s_suppkey % 15 AS double) AS BuildingAddress__Latitude__s, cast(130 + s_suppkey % 15 AS double) AS BuildingAddress__Longitude__s,
          concat('owner-', s_name) AS BuildingOwnerName_ForFlow__c, concat('design-', s_name) AS DesignOfiiceName_ForFlow__c, concat('gc-', s_name) AS GCName_ForFlow__c,
          n_name AS BranchInCharge__c, r_name AS ResponsibleArea__c, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE 'former' END AS NewlyEstablishedFormerConstruction__c,
          s_suppkey % 23 = 22 AS IsDeleted
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
    "departmentmst__c": """
        SELECT concat('a0D', lpad(cast(n_nationkey AS string), 15, '0')) AS Id, n_name AS Name, concat(r_name, '/', n_name) AS DepartmentName__c,
          lpad(cast(n_nationkey AS string), 3, '0') AS DepartmentCode__c, concat('a0R', lpad(cast(r_regionkey AS string), 15, '0')) AS ParentDepartment__c, r_name AS ParentName__c,
          lpad(cast(r_regionkey AS string), 3, '0') AS ParentCode__c, cast(n_nationkey % 3 AS double) + 0.6 AS Level__c,
          concat('MS', cast(n_nationkey % 7 AS string)) AS MotherStoreCode__c, concat('AREA', cast(r_regionkey AS string)) AS AreaCode__c,
          n_nationkey = 13 AS IsDeleted
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "opportunity": """
        SELECT concat('006', lpad(cast(o_orderkey AS string), 15, '0')) AS Id, concat('001', lpad(cast(o_custkey AS string), 15, '0')) AS AccountId,
          concat('012', lpad(cast(cast(substr(o_orderpriority, 1, 1) AS int) - 1 AS string), 15, '0')) AS RecordTypeId, concat('005', lpad(cast(o_custkey % 97 AS string), 15, '0')) AS OwnerId,
          concat('a0D', lpad(cast(c_nationkey AS string), 15, '0')) AS MainCompanyDepartmentCharge__c,
          CASE WHEN o_orderkey % 4 <> 0 THEN concat('001', lpad(cast(o_custkey - o_custkey % 7 AS string), 15, '0')) END AS Design__c,
          CASE WHEN o_orderkey % 6 <> 0 THEN concat('001', lpad(cast(o_custkey - o_custkey % 3 AS string), 15, '0')) END AS BuidingOwner__c,
          concat('opp-', cast(o_orderkey AS string)) AS Name, CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'P' THEN 'Proposal' ELSE 'Prospecting' END AS StageName,
          cast(o_totalprice AS decimal(15,2)) AS Amount, cast(o_orderkey % 11 * 10 AS double) AS Probability, cast(o_totalprice AS decimal(15,2)) * 0.25 AS ExpectedRevenue,
          CASE WHEN o_orderkey % 8 <> 0 THEN cast(o_totalprice AS decimal(15,2)) * 0.5 END AS ContractExpectationAmount__c, cast(o_orderkey % 9 AS double) AS TotalOpportunityQuantity,
          cast(o_orderdate + INTERVAL 9497 DAY AS date) AS CloseDate,
          CASE WHEN o_orderkey % 5 <> 0 THEN cast(o_orderdate + INTERVAL 8997 DAY AS date) END AS ContractExpectationDate__c,
          cast(o_orderdate + INTERVAL 9600 DAY AS date) AS ConstructionStartDate__c, cast(o_orderdate + INTERVAL 9660 DAY AS date) AS MainConstructionStartDate__c,
          cast(o_orderdate + INTERVAL 9700 DAY AS date) AS InstallationPeriod__c, cast(o_orderdate + INTERVAL 9800 DAY AS date) AS ContractDeliveryDate__c,
          CASE WHEN o_orderkey % 3 = 0 THEN 'New' ELSE 'Renewal' END AS Type, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Web' END AS LeadSource,
          o_orderstatus AS ForecastCategory, concat('forecast-', o_orderstatus) AS ForecastCategoryName, concat('cf-', cast(o_orderkey % 3 AS string)) AS ContractForecast__c,
          o_orderstatus <> 'O' AS IsClosed, CASE WHEN o_orderkey % 50 = 49 THEN NULL ELSE o_orderstatus = 'F' END AS IsWon,
          o_orderdate + INTERVAL 9497 DAY AS CreatedDate, o_orderdate + INTERVAL 9500 DAY AS LastModifiedDate,
          cast(o_orderdate + INTERVAL 9497 DAY AS date) AS LastActivityDate, o_orderdate + INTERVAL 9499 DAY AS LastStageChangeDate,
          CASE WHEN o_orderkey % 53 = 52 THEN NULL ELSE o_orderkey % 47 = 46 END AS IsDeleted
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "opportunity_asset__c": """
        SELECT concat('a0A', lpad(cast(l_orderkey AS string), 9, '0'), lpad(cast(l_partkey AS string), 9, '0')) AS Id,
          concat('006', lpad(cast(l_orderkey AS string), 15, '0')) AS Opportunity__c, concat('02i', lpad(cast(l_partkey AS string), 15, '0')) AS Asset__c, l_partkey % 2 = 0 AS CarryOver__c,
          concat('OA-', cast(l_orderkey AS string), '-', cast(l_partkey AS string)) AS OpportunityAssetCode__c, concat('oa-', cast(l_partkey AS string)) AS Name,
          l_partkey % 43 = 42 AS IsDeleted
        FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) k
    """,
    "opportunitybuilding__c": """
        SELECT concat('a0O', lpad(cast(l_orderkey AS string), 9, '0'), lpad(cast(l_suppkey AS string), 9, '0')) AS Id,
          concat('006', lpad(cast(l_orderkey AS string), 15, '0')) AS Opportunity__c, concat('a0B', lpad(cast(l_suppkey AS string), 15, '0')) AS Building__c,
          concat('exp-', cast(l_suppkey AS string)) AS Building_Exp__c, concat('ob-', cast(l_suppkey AS string)) AS Name, l_suppkey % 19 = 18 AS IsDeleted
        FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) k
    """,
    "opportunitylineitem": """
        SELECT concat('00k', lpad(cast(l_orderkey AS string), 9, '0'), cast(l_linenumber AS string), '-', lpad(cast(l_partkey AS string), 7, '0'), '-', lpad(cast(l_suppkey AS string), 5, '0'), '-', cast(cast(l_shipdate AS date) AS string)) AS Id,
          concat('006', lpad(cast(l_orderkey AS string), 15, '0')) AS OpportunityId, concat('01t', lpad(cast(l_partkey AS string), 15, '0')) AS Product2Id, concat('01u', lpad(cast(l_partkey AS string), 15, '0')) AS PricebookEntryId,
          concat('raw-', cast(l_partkey AS string)) AS ProductCode, concat('line-', cast(l_partkey AS string)) AS Name,
          CASE WHEN l_partkey % 4 <> 0 THEN concat('desc-', cast(l_partkey AS string)) END AS Description, cast(abs(l_discount) AS decimal(4,2)) AS Discount,
          cast(l_extendedprice AS decimal(15,2)) * 0.8 AS UnitPrice, cast(l_extendedprice AS decimal(15,2)) AS ListPrice, cast(l_extendedprice AS decimal(15,2)) AS Subtotal, cast(l_extendedprice AS decimal(15,2)) * (1 - cast(abs(l_discount) AS decimal(4,2))) AS TotalPrice,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_extendedprice AS decimal(15,2)) * 0.875 END AS CurrentContractAmount__c, cast(l_extendedprice AS decimal(15,2)) * 0.75 AS BPREstimatedAmount__c,
          cast(l_extendedprice AS decimal(15,2)) * 1.125 AS OfferedAmount__c, cast(l_extendedprice AS decimal(15,2)) * 1.25 AS EstimatedAmount__c, cast(l_extendedprice AS decimal(15,2)) * 0.125 AS Profit__c,
          cast(l_partkey % 40 AS decimal(9,2)) AS ProfitRatio__c, cast(l_suppkey % 30 AS decimal(9,2)) AS MLRatio__c, cast(l_linenumber * 10 AS decimal(9,2)) AS QuotationRatio__c,
          cast(l_extendedprice AS decimal(15,2)) * -0.5 AS IncreaseDecrease__c, cast(l_quantity AS int) AS Quantity__c, concat('W', cast(l_orderkey AS string)) AS WorkNumber__c,
          concat('bldg-', cast(l_suppkey AS string)) AS Building__c, concat('a0B', lpad(cast(l_suppkey AS string), 15, '0')) AS BuildingID__c,
          concat('a0O', lpad(cast(l_orderkey AS string), 9, '0'), lpad(cast(l_suppkey AS string), 9, '0')) AS Opportunity_Building__c,
          l_linestatus AS DeliveryModelName__c, l_returnflag AS BPRModel1__c, 'Standard' AS OpportunityRecordTypedev__c, concat('BS', cast(l_linenumber AS string)) AS BusinessSheetCode__c,
          l_linenumber AS SortOrder, CASE WHEN l_returnflag <> 'N' THEN cast(l_shipdate + INTERVAL 9497 DAY AS date) END AS ServiceDate,
          l_shipdate + INTERVAL 9497 DAY AS CreatedDate, l_shipdate + INTERVAL 9500 DAY AS LastModifiedDate, (l_orderkey + l_linenumber) % 59 = 58 AS IsDeleted
        FROM lineitem
    """,
    "product2": """
        SELECT concat('01t', lpad(cast(p_partkey AS string), 15, '0')) AS Id, p_name AS Name, p_brand AS ProductCode, concat('product ', p_name) AS Description, p_size <= 40 AS IsActive,
          p_type AS Family, p_size = 50 AS IsArchived, (SELECT min(o_orderdate) FROM orders) + INTERVAL 9497 DAY AS CreatedDate, (SELECT min(o_orderdate) FROM orders) + INTERVAL 10497 DAY AS LastModifiedDate,
          p_partkey % 37 = 36 AS IsDeleted
        FROM part
    """,
    "recordtype": """
        SELECT concat('012', lpad(cast(cast(substr(o_orderpriority, 1, 1) AS int) - 1 AS string), 15, '0')) AS Id, o_orderpriority AS Name, upper(replace(substr(o_orderpriority, 3), ' ', '_')) AS DeveloperName,
          cast(NULL AS string) AS Description, 'Opportunity' AS SobjectType, o_orderpriority <> '5-LOW' AS IsActive
        FROM (SELECT DISTINCT o_orderpriority FROM orders) p
    """,
    "user": """
        SELECT concat('005', lpad(cast(user_id AS string), 15, '0')) AS Id, concat('u', cast(user_id AS string), '@example.com') AS Username, concat('User ', cast(user_id AS string)) AS Name,
          'User' AS FirstName, cast(user_id AS string) AS LastName, 'Example' AS CompanyName, concat('Div ', cast(user_id % 4 AS string)) AS Division,
          concat('Dept ', cast(user_id % 9 AS string)) AS Department, CASE WHEN user_id % 6 = 0 THEN NULL ELSE concat('Title ', cast(user_id % 3 AS string)) END AS Title,
          concat('City ', cast(user_id % 12 AS string)) AS City, concat('State ', cast(user_id % 5 AS string)) AS State, lpad(cast(user_id AS string), 7, '0') AS PostalCode
        FROM (SELECT DISTINCT user_id FROM events) u
    """,
}

#: Bytes of a table that a task reads at most. A compressed line of 20 bytes becomes a raw row of 600, so that a
#: task of Spark's 128 MB would spill what it shuffles.
SPLIT_BYTES = 8 << 20

INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def crm_source(spark: SparkSession, sf_dir: str) -> Source:
    """Raw tables as DataFrames over the Parquet files of ``sf_dir``, read in small splits by all of the session."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)

    def read(name: str) -> DataFrame:
        sql = MAPPING[name]
        for table in INPUTS:
            if re.search(rf"\b(FROM|JOIN) {table}\b", sql):
                spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
        return conform(spark.sql(sql), raw_table(name))

    return read


def write_raw(spark: SparkSession, sf_dir: str, out: str, files: int) -> str:
    """The raw tables as Parquet folders of several files each, as an export leaves them."""
    source = crm_source(spark, sf_dir)
    for name in MAPPING:
        source(name).repartition(files).write.mode("overwrite").parquet(f"{out}/{name}")
    return out
