"""The eleven raw CRM tables: columns, types, and how to read them.

One declaration per table serves both the reader (raw name and type) and the
staging projection (output name and cast).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ankenmart.operators.projection import ident, renamed

NAMESPACE = "salesforce"

# Wide enough for any amount or ratio an export may hold; staging narrows money.
NUMBER = "decimal(24,6)"


@dataclass(frozen=True)
class RawColumn:
    name: str
    type: str
    staged: str | None  # None: read for the filter only
    cast: str | None


@dataclass(frozen=True)
class RawTable:
    name: str
    staged: str  # name of the staging model
    key: str  # staged key column
    keep: tuple[str, bool] | None  # rows stay where this flag has this value
    columns: tuple[RawColumn, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.type}" for c in self.columns))


def _table(
    name: str, staged: str, key: str, columns: str, keep: tuple[str, bool] | None = ("IsDeleted", False)
) -> RawTable:
    parsed = []
    for line in columns.strip().splitlines():
        raw, kind, *rest = line.split()
        staged_name = rest[0] if rest else None
        cast = rest[1] if len(rest) > 1 else None
        parsed.append(RawColumn(raw, NUMBER if kind == "number" else kind, staged_name, cast))
    if keep is not None and keep[0] not in {c.name for c in parsed}:
        parsed.append(RawColumn(keep[0], "boolean", None, None))
    return RawTable(name, staged, key, keep, tuple(parsed))


# Raw column, type, output column, and the cast where there is one.
RAW_TABLES: dict[str, RawTable] = {
    t.name: t
    for t in (
        _table("account", "stg_account", "account_id", """
            Id string account_id
            Name string account_name
            Type string account_type
            RecordTypeId string record_type_id
            ParentId string parent_account_id
            BillingCity string billing_city
            BillingState string billing_state
            BillingPostalCode string billing_postal_code
            BillingCountry string billing_country
            ShippingCity string shipping_city
            ShippingState string shipping_state
            ShippingPostalCode string shipping_postal_code
            ShippingCountry string shipping_country
        """),
        _table("asset", "stg_asset", "asset_id", """
            Id string asset_id
            Name string asset_name
            AccountId string account_id
            SerialNumber string serial_number
            Status string status
            ProductCode string product_code
            ProductFamily string product_family
            ProductName__c string product_name
            InstallDate date install_date
            ManufactureDate date manufacture_date
            PurchaseDate date purchase_date
            UsageEndDate date usage_end_date
            IsCompetitorProduct boolean is_competitor_product
            CreatedDate timestamp created_date
            LastModifiedDate timestamp last_modified_date
        """),
        _table("building__c", "stg_building", "building_id", """
            Id string building_id
            Name string building_name
            BuildingControlNumber__c string building_control_number
            NumberOfFloors__c double number_of_floors int
            TotalNumberUnits__c double total_number_units int
            AddressState__c string address_state
            BuildingAddress__Street__s string address_street
            BuildingAddress__City__s string address_city
            BuildingAddress__PostalCode__s string address_postal_code
            BuildingAddress__StateCode__s string address_state_code
            BuildingAddress__CountryCode__s string address_country_code
            BuildingAddress__Latitude__s double latitude
            BuildingAddress__Longitude__s double longitude
            BuildingOwnerName_ForFlow__c string building_owner_name
            DesignOfiiceName_ForFlow__c string design_office_name
            GCName_ForFlow__c string general_contractor_name
            BranchInCharge__c string branch_in_charge
            ResponsibleArea__c string responsible_area
            NewlyEstablishedFormerConstruction__c string newly_established_former_construction
        """),
        _table("departmentmst__c", "stg_department", "department_id", """
            Id string department_id
            Name string department_name
            DepartmentName__c string department_full_name
            DepartmentCode__c string department_code
            ParentDepartment__c string parent_department_id
            ParentName__c string parent_department_name
            ParentCode__c string parent_department_code
            Level__c double hierarchy_level int
            MotherStoreCode__c string mother_store_code
            AreaCode__c string area_code
        """),
        _table("opportunity", "stg_opportunity", "opportunity_id", """
            Id string opportunity_id
            AccountId string account_id
            RecordTypeId string record_type_id
            OwnerId string owner_id
            MainCompanyDepartmentCharge__c string department_id
            Design__c string design_id
            BuidingOwner__c string building_owner_id
            Name string opportunity_name
            StageName string stage_name
            Amount number amount money
            Probability double probability
            ExpectedRevenue number expected_revenue money
            ContractExpectationAmount__c number contract_expectation_amount money
            TotalOpportunityQuantity double total_quantity
            CloseDate date close_date
            ContractExpectationDate__c date contract_expectation_date
            ConstructionStartDate__c date construction_start_date
            MainConstructionStartDate__c date main_construction_start_date
            InstallationPeriod__c date installation_period
            ContractDeliveryDate__c date contract_delivery_date
            Type string opportunity_type
            LeadSource string lead_source
            ForecastCategory string forecast_category
            ForecastCategoryName string forecast_category_name
            ContractForecast__c string contract_forecast
            IsClosed boolean is_closed
            IsWon boolean is_won
            CreatedDate timestamp created_date
            LastModifiedDate timestamp last_modified_date
            LastActivityDate date last_activity_date
            LastStageChangeDate timestamp last_stage_change_date
        """),
        _table("opportunity_asset__c", "stg_opportunity_asset", "opportunity_asset_id", """
            Id string opportunity_asset_id
            Opportunity__c string opportunity_id
            Asset__c string asset_id
            CarryOver__c boolean is_carry_over
            OpportunityAssetCode__c string opportunity_asset_code
            Name string name
        """),
        _table("opportunitybuilding__c", "stg_opportunity_building", "opportunity_building_id", """
            Id string opportunity_building_id
            Opportunity__c string opportunity_id
            Building__c string building_id
            Building_Exp__c string building_description
            Name string name
        """),
        _table("opportunitylineitem", "stg_opportunity_line_item", "line_item_id", """
            Id string line_item_id
            OpportunityId string opportunity_id
            Product2Id string product_id
            PricebookEntryId string pricebook_entry_id
            ProductCode string product_code
            Name string product_name
            Description string description
            Discount number discount
            UnitPrice number unit_price money
            ListPrice number list_price money
            Subtotal number subtotal money
            TotalPrice number total_price money
            CurrentContractAmount__c number current_contract_amount money
            BPREstimatedAmount__c number bpr_estimated_amount money
            OfferedAmount__c number offered_amount money
            EstimatedAmount__c number estimated_amount money
            Profit__c number profit money
            ProfitRatio__c number profit_ratio
            MLRatio__c number ml_ratio
            QuotationRatio__c number quotation_ratio
            IncreaseDecrease__c number increase_decrease money
            Quantity__c int quantity
            WorkNumber__c string work_number
            Building__c string building
            BuildingID__c string building_id
            Opportunity_Building__c string opportunity_building
            DeliveryModelName__c string delivery_model_name
            BPRModel1__c string bpr_model
            OpportunityRecordTypedev__c string opportunity_record_type
            BusinessSheetCode__c string business_sheet_code
            SortOrder int sort_order
            ServiceDate date service_date
            CreatedDate timestamp created_date
            LastModifiedDate timestamp last_modified_date
        """),
        _table("product2", "stg_product", "product_id", """
            Id string product_id
            Name string product_name
            ProductCode string product_code
            Description string description
            IsActive boolean is_active
            Family string family
            IsArchived boolean is_archived
            CreatedDate timestamp created_date
            LastModifiedDate timestamp last_modified_date
        """),
        _table("recordtype", "stg_record_type", "record_type_id", """
            Id string record_type_id
            Name string record_type_name
            DeveloperName string developer_name
            Description string description
            SobjectType string sobject_type
        """, keep=("IsActive", True)),
        _table("user", "stg_user", "user_id", """
            Id string user_id
            Username string username
            Name string full_name
            FirstName string first_name
            LastName string last_name
            CompanyName string company_name
            Division string division
            Department string department
            Title string title
            City string city
            State string state
            PostalCode string postal_code
        """, keep=None),
    )
}

Source = Callable[[str], DataFrame]


def conform(rows: DataFrame, table: RawTable) -> DataFrame:
    """The declared columns, found by name without regard to case."""
    have = {c.lower() for c in rows.columns}
    missing = [c.name for c in table.columns if c.name.lower() not in have]
    if missing:
        raise ValueError(f"raw table {table.name} lacks {', '.join(missing)}")
    return renamed(rows, [(c.name, c.name) for c in table.columns])


def raw_table(name: str) -> RawTable:
    try:
        return RAW_TABLES[name]
    except KeyError:
        raise ValueError(f"no raw table {name!r} in {NAMESPACE}") from None


@dataclass(frozen=True)
class LastingSource:
    """Raw tables under names that outlast the session, so that catalog views can be made over them."""

    read: Source
    relation: Callable[[str], str]

    def __call__(self, name: str) -> DataFrame:
        return self.read(name)


def parquet_source(spark: SparkSession, folder: str) -> LastingSource:
    """Raw tables as Parquet, one folder or file per table below ``folder``."""
    return LastingSource(
        lambda name: conform(spark.read.parquet(f"{folder}/{raw_table(name).name}"), raw_table(name)),
        lambda name: f"parquet.{ident(f'{folder}/{raw_table(name).name}')}",
    )


def catalog_source(spark: SparkSession, database: str = NAMESPACE) -> LastingSource:
    """Raw tables in the catalog. Quoted, as ``user`` is a reserved word."""
    table = lambda name: f"{ident(database)}.{ident(raw_table(name).name)}"
    return LastingSource(lambda name: conform(spark.table(table(name)), raw_table(name)), table)


def frame_source(frames: Mapping[str, DataFrame]) -> Source:
    return lambda name: conform(frames[raw_table(name).name], raw_table(name))
