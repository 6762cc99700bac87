"""The cleaned tables, one declaration each over the raw tables they read.

The base row of a part is aliased ``b``. Keys, orders and columns follow the raw
schemas; ``operators.cleaning.clean`` runs them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tarnlake.operators.cleaning import CleanSpec, Lookup, Part, clean


def _same(*names: str, **renamed: str) -> dict[str, str]:
    """Columns kept under their own name, plus renamed ones (new name = expression)."""
    return {**{n: f"b.{n}" for n in names}, **renamed}


def _typed(types: Mapping[str, str], cast: str) -> dict[str, str]:
    """Positional text columns to named, typed ones."""
    return {
        name: f"b._c{i}" if kind == "string" else f"{cast}(b._c{i} as {kind})"
        for i, (name, kind) in enumerate(types.items())
    }


# Columns of the two history files, in file order.
ORDER_HEADER = {
    "SalesOrderID": "bigint", "RevisionNumber": "int", "OrderDate": "timestamp",
    "DueDate": "timestamp", "ShipDate": "timestamp", "Status": "int",
    "OnlineOrderFlag": "boolean", "SalesOrderNumber": "string",
    "PurchaseOrderNumber": "string", "AccountNumber": "string", "CustomerID": "bigint",
    "SalesPersonID": "bigint", "TerritoryID": "bigint", "BillToAddressID": "bigint",
    "ShipToAddressID": "bigint", "ShipMethodID": "bigint", "CreditCardID": "bigint",
    "CreditCardApprovalCode": "string", "CurrencyRateID": "bigint",
    "SubTotal": "decimal(19,4)", "TaxAmt": "decimal(19,4)", "Freight": "decimal(19,4)",
    "TotalDue": "decimal(19,4)", "Comment": "string",
}
ORDER_DETAIL = {
    "SalesOrderID": "bigint", "SalesOrderDetailID": "bigint", "CarrierTrackingNumber": "string",
    "OrderQty": "int", "ProductID": "bigint", "SpecialOfferID": "bigint",
    "UnitPrice": "decimal(19,4)", "UnitPriceDiscount": "decimal(19,4)",
    "LineTotal": "decimal(38,6)",
}

_TRANSACTION = dict(
    TransactionID="b.transactionid", ProductID="b.productid",
    ReferenceOrderID="b.referenceorderid", ReferenceOrderLineID="b.referenceorderlineid",
    TransactionDate="b.transactiondate", TransactionType="b.transactiontype",
    Quantity="cast(b.quantity as int)", ActualCost="b.actualcost",
)

SPECS = {
    s.name: s
    for s in (
        CleanSpec(
            "clean_hr_employee",
            (Part("humanresources_employee", dict(
                EmployeeID="b.businessentityid", JobTitle="b.jobtitle", HireDate="b.hiredate",
                BirthDate="b.birthdate", Gender="b.gender", MaritalStatus="b.maritalstatus",
                VacationHours="b.vacationhours", SickLeaveHours="b.sickleavehours")),),
            ("EmployeeID",), ("EmployeeID",), ("HireDate desc",)),
        CleanSpec(
            "clean_hr_employee_org_history",
            (Part("humanresources_employeedepartmenthistory", dict(
                EmployeeID="b.businessentityid", DepartmentID="b.departmentid",
                ShiftID="b.shiftid", StartDate="b.startdate", EndDate="b.enddate",
                JobTitle="e.jobtitle", HireDate="e.hiredate", Gender="e.gender",
                DepartmentName="d.name", DepartmentGroup="d.groupname", ShiftName="s.name",
                ShiftStartTime="s.starttime", ShiftEndTime="s.endtime"),
                (Lookup("humanresources_employee", "e", "b.businessentityid = e.businessentityid"),
                 Lookup("humanresources_department", "d", "b.departmentid = d.departmentid"),
                 Lookup("humanresources_shift", "s", "b.shiftid = s.shiftid"))),),
            ("EmployeeID", "DepartmentID", "StartDate"),
            ("EmployeeID", "DepartmentID", "StartDate"), ("EndDate desc",)),
        CleanSpec(
            "clean_hr_employee_pay_history",
            (Part("humanresources_employeepayhistory", dict(
                EmployeeID="b.businessentityid", RateChangeDate="b.ratechangedate",
                PayRate="cast(b.rate as decimal(18,2))", PayFrequency="b.payfrequency",
                JobTitle="e.jobtitle"),
                (Lookup("humanresources_employee", "e", "b.businessentityid = e.businessentityid"),)),),
            ("EmployeeID", "RateChangeDate"), ("EmployeeID", "RateChangeDate"), ("PayRate desc",)),
        CleanSpec(
            "clean_person",
            (Part("person_person", dict(
                PersonID="b.businessentityid", PersonType="b.persontype", NameStyle="b.namestyle",
                Title="b.title", FirstName="b.firstname", MiddleName="b.middlename",
                LastName="b.lastname", Suffix="b.suffix", EmailPromotion="b.emailpromotion"),
                (Lookup("person_businessentity", "be", "b.businessentityid = be.businessentityid", "inner"),)),),
            ("PersonID",), ("PersonID",)),
        CleanSpec(
            "clean_person_contact",
            (Part("person_businessentitycontact", dict(
                PersonID="b.businessentityid", RelatedPersonID="b.personid",
                ContactTypeName="ct.name", FirstName="p.firstname", LastName="p.lastname"),
                (Lookup("person_contacttype", "ct", "b.contacttypeid = ct.contacttypeid"),
                 Lookup("person_person", "p", "b.personid = p.businessentityid"))),),
            ("PersonID",), ("PersonID", "ContactTypeName", "RelatedPersonID")),
        CleanSpec(
            "clean_person_contact_method",
            (Part("person_emailaddress", dict(
                PersonID="b.businessentityid", ContactType="'EMAIL'",
                ContactValue="b.emailaddress", ContactSubtype="cast(null as string)")),
             Part("person_personphone", dict(
                PersonID="b.businessentityid", ContactType="'PHONE'",
                ContactValue="b.phonenumber", ContactSubtype="t.name"),
                (Lookup("person_phonenumbertype", "t", "b.phonenumbertypeid = t.phonenumbertypeid"),))),
            ("PersonID",), ("PersonID", "ContactType", "ContactValue")),
        CleanSpec(
            "clean_person_address",
            (Part("person_businessentityaddress", dict(
                AddressID="b.addressid", PersonID="b.businessentityid", AddressTypeName="at.name",
                AddressLine1="a.addressline1", AddressLine2="a.addressline2", City="a.city",
                StateProvinceName="sp.name", CountryName="cr.name", PostalCode="a.postalcode",
                SpatialLocation="a.spatiallocationstring"),
                (Lookup("person_address", "a", "b.addressid = a.addressid"),
                 Lookup("person_addresstype", "at", "b.addresstypeid = at.addresstypeid"),
                 Lookup("person_stateprovince", "sp", "a.stateprovinceid = sp.stateprovinceid"),
                 Lookup("person_countryregion", "cr", "sp.countryregioncode = cr.countryregioncode"))),),
            ("AddressID",), ("AddressID",)),
        CleanSpec(
            "clean_production",
            (Part("production_product", dict(
                ProductID="b.productid", ProductNumber="b.productnumber", ProductName="b.name",
                Color="b.color", Size="b.size", Weight="b.weight", StandardCost="b.standardcost",
                ListPrice="b.listprice", ProductModelName="pm.name",
                ProductSubcategoryName="psc.name", ProductCategoryName="pc.name",
                SizeUnitMeasure="us.name", WeightUnitMeasure="uw.name",
                SellStartDate="b.sellstartdate", SellEndDate="b.sellenddate",
                MakeFlag="b.makeflag", FinishedGoodsFlag="b.finishedgoodsflag"),
                (Lookup("production_productsubcategory", "psc", "b.productsubcategoryid = psc.productsubcategoryid"),
                 Lookup("production_productcategory", "pc", "psc.productcategoryid = pc.productcategoryid"),
                 Lookup("production_productmodel", "pm", "b.productmodelid = pm.productmodelid"),
                 Lookup("production_unitmeasure", "us", "b.sizeunitmeasurecode = us.unitmeasurecode"),
                 Lookup("production_unitmeasure", "uw", "b.weightunitmeasurecode = uw.unitmeasurecode"))),),
            ("ProductID",), ("ProductID",)),
        CleanSpec(
            "clean_production_inventory",
            (Part("production_productinventory", dict(
                ProductID="b.productid", LocationID="b.locationid",
                Quantity="cast(b.quantity as int)", LocationName="l.name",
                LocationCostRate="l.costrate", LocationAvailability="l.availability"),
                (Lookup("production_location", "l", "b.locationid = l.locationid"),)),),
            ("ProductID", "LocationID"), ("ProductID", "LocationID")),
        CleanSpec(
            "clean_production_transaction",
            (Part("production_transactionhistory", _TRANSACTION),
             Part("production_transactionhistoryarchive", _TRANSACTION)),
            ("TransactionID",), ("TransactionID",)),
        CleanSpec(
            "clean_production_workorder",
            (Part("production_workorder", dict(
                WorkOrderID="b.workorderid", ProductID="b.productid", StartDate="b.startdate",
                EndDate="b.enddate", DueDate="b.duedate",
                OrderQuantity="cast(b.orderqty as int)",
                ScrappedQuantity="cast(b.scrappedqty as int)", ScrapReason="s.name"),
                (Lookup("production_scrapreason", "s", "b.scrapreasonid = s.scrapreasonid"),)),),
            ("WorkOrderID",), ("WorkOrderID",)),
        CleanSpec(
            "clean_production_bill_of_materials",
            (Part("production_billofmaterials", dict(
                ProductAssemblyID="b.productassemblyid", ComponentProductID="b.componentid",
                PerAssemblyQuantity="b.perassemblyqty", StartDate="b.startdate",
                EndDate="b.enddate")),),
            ("ProductAssemblyID", "ComponentProductID", "StartDate"),
            ("ProductAssemblyID", "ComponentProductID", "StartDate"), ("EndDate desc",)),
        CleanSpec(
            "clean_production_cost_history",
            (Part("production_productcosthistory", dict(
                ProductID="b.productid", StartDate="b.startdate", EndDate="b.enddate",
                StandardCost="b.standardcost")),),
            ("ProductID", "StartDate"), ("ProductID", "StartDate"), ("StandardCost desc",)),
        CleanSpec(
            "clean_production_list_price_history",
            (Part("production_productlistpricehistory", dict(
                ProductID="b.productid", StartDate="b.startdate", EndDate="b.enddate",
                ListPrice="b.listprice")),),
            ("ProductID", "StartDate"), ("ProductID", "StartDate"), ("ListPrice desc",)),
        CleanSpec(
            "clean_purchasing_vendor",
            (Part("purchasing_vendor", dict(
                VendorID="b.businessentityid", AccountNumber="b.accountnumber", VendorName="b.name",
                CreditRating="b.creditrating", PreferredVendorStatus="b.preferredvendorstatus",
                ActiveFlag="b.activeflag")),),
            ("VendorID",), ("VendorID",)),
        CleanSpec(
            "clean_purchasing_product_vendor",
            (Part("purchasing_productvendor", dict(
                ProductID="b.productid", VendorID="b.businessentityid",
                AverageLeadTime="cast(b.averageleadtime as int)", StandardPrice="b.standardprice",
                LastReceiptCost="b.lastreceiptcost", LastReceiptDate="b.lastreceiptdate",
                MinOrderQty="cast(b.minorderqty as int)", MaxOrderQty="cast(b.maxorderqty as int)",
                OnOrderQty="cast(b.onorderqty as int)", UnitMeasureCode="b.unitmeasurecode",
                UnitMeasureName="u.name"),
                (Lookup("production_unitmeasure", "u", "b.unitmeasurecode = u.unitmeasurecode"),)),),
            ("ProductID", "VendorID"), ("ProductID", "VendorID")),
        CleanSpec(
            "clean_purchasing_order",
            (Part("purchasing_purchaseorderheader", dict(
                PurchaseOrderID="b.purchaseorderid", VendorID="b.vendorid", VendorName="v.name",
                OrderStatus="b.status", OrderDate="b.orderdate", ShipDate="b.shipdate",
                SubTotal="b.subtotal", TaxAmount="b.taxamt", Freight="b.freight",
                TotalDue="b.totaldue", ShipMethodName="s.name", ShipBase="s.shipbase",
                ShipRate="s.shiprate"),
                (Lookup("purchasing_vendor", "v", "b.vendorid = v.businessentityid"),
                 Lookup("purchasing_shipmethod", "s", "b.shipmethodid = s.shipmethodid"))),),
            ("PurchaseOrderID",), ("PurchaseOrderID",), ("OrderDate desc",)),
        CleanSpec(
            "clean_purchasing_order_line",
            (Part("purchasing_purchaseorderdetail", dict(
                PurchaseOrderID="b.purchaseorderid", PurchaseOrderDetailID="b.purchaseorderdetailid",
                ProductID="b.productid", DueDate="b.duedate",
                OrderQuantity="cast(b.orderqty as int)", ReceivedQuantity="cast(b.receivedqty as int)",
                RejectedQuantity="cast(b.rejectedqty as int)",
                StockedQuantity="cast(b.stockedqty as int)", UnitPrice="b.unitprice",
                LineTotal="b.linetotal")),),
            ("PurchaseOrderID", "PurchaseOrderDetailID"),
            ("PurchaseOrderID", "PurchaseOrderDetailID")),
        CleanSpec(
            "clean_sales_order_header",
            (Part("sales_salesorderheader", _same(*ORDER_HEADER)),
             Part("csv_salesorderheader", _typed(ORDER_HEADER, "try_cast"))),
            ("SalesOrderID",)),
        CleanSpec(
            "clean_sales_order_detail",
            (Part("sales_salesorderdetail", _same(*ORDER_DETAIL)),
             Part("csv_salesorderdetail", _typed(ORDER_DETAIL, "try_cast"))),
            ("SalesOrderDetailID",), ("SalesOrderDetailID",)),
        CleanSpec(
            "clean_sales_customer",
            (Part("sales_customer", dict(
                CustomerID="b.customerid", PersonID="b.personid", StoreID="b.storeid",
                TerritoryID="b.territoryid")),),
            ("CustomerID",), ("CustomerID",)),
        CleanSpec(
            "clean_sales_store",
            (Part("sales_store", dict(
                StoreID="b.businessentityid", StoreName="b.name", SalesPersonID="b.salespersonid")),),
            ("StoreID",), ("StoreID",)),
        CleanSpec(
            "clean_sales_territory",
            (Part("sales_salesterritory", dict(
                TerritoryID="b.territoryid", TerritoryName="b.name",
                CountryRegionCode="b.countryregioncode", TerritoryGroup="b.`group`")),),
            ("TerritoryID",), ("TerritoryID",)),
        CleanSpec(
            "clean_sales_currency",
            (Part("sales_currency", dict(CurrencyCode="b.currencycode", CurrencyName="b.name")),),
            ("CurrencyCode",), ("CurrencyCode",)),
        CleanSpec(
            "clean_sales_currency_rate",
            (Part("sales_currencyrate", dict(
                CurrencyRateID="b.currencyrateid", FromCurrencyCode="b.fromcurrencycode",
                ToCurrencyCode="b.tocurrencycode", CurrencyRateDate="b.currencyratedate",
                AverageRate="b.averagerate", EndOfDayRate="b.endofdayrate")),),
            ("CurrencyRateID",), ("CurrencyRateID",), ("CurrencyRateDate desc",)),
        CleanSpec(
            "clean_sales_special_offer",
            (Part("sales_specialoffer", _same(
                "specialofferid", "description", "discountpct", "type", "category",
                "startdate", "enddate")),),
            ("specialofferid",)),
        CleanSpec(
            "clean_sales_special_offer_product",
            (Part("sales_specialofferproduct", _same("specialofferid", "productid")),),
            ("specialofferid", "productid"), ("specialofferid", "productid")),
        CleanSpec(
            "clean_sales_person_quota_history",
            (Part("sales_salespersonquotahistory", _same("businessentityid", "quotadate", "salesquota")),),
            ("businessentityid", "quotadate"), ("businessentityid", "quotadate"), ("salesquota desc",)),
        CleanSpec(
            "clean_sales_territory_history",
            (Part("sales_salesterritoryhistory", _same(
                "businessentityid", "territoryid", "startdate", "enddate")),),
            ("businessentityid", "territoryid", "startdate"),
            ("businessentityid", "territoryid", "startdate"), ("enddate desc",)),
    )
}


def clean_table(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    return clean(tables, SPECS[name])
