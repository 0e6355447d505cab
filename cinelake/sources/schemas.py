"""Fixed schemas of the star's tables, accepted table names and column aliases."""

# Table layouts.
CATEGORY = "Key BIGINT, ID BIGINT, Name STRING"
GEOGRAPHY = (
    "Key BIGINT, ID BIGINT, Address STRING, State STRING, City STRING, Country STRING, "
    "`Country Slag` STRING, `Postal Code` STRING"
)
LANGUAGE = "Key BIGINT, ID STRING, ISO STRING, Name STRING"
CONTENT_CATEGORY = "`Content Key` BIGINT, `Category Key` BIGINT"
CONTENT_TALENT = "`Content Key` BIGINT, `Talent Key` BIGINT, Character STRING"
PAYMENT_METHOD = "Key BIGINT, `Card ID` BIGINT, `Card Type` STRING, `Card Expiry Date` STRING"
PROVIDER = "Key BIGINT, ID BIGINT, Name STRING, Type STRING, Country STRING"
PLAN = "Key BIGINT, Type STRING, `Monthly Fee` DOUBLE, `Max Devices` BIGINT, `Video Quality` STRING"
TALENT = "Key BIGINT, `Actor ID` BIGINT, `First Name` STRING, `Last Name` STRING"
CUSTOMER = (
    "Key BIGINT, `First Name` STRING, `Last Name` STRING, Email STRING, Gender STRING, "
    "Birth STRING, `Geography Key` BIGINT, `Is Active` BOOLEAN, `Create Date` STRING"
)
CONTENT = "Key BIGINT, Title STRING, `Release Year` INT, Revenue BIGINT"
EVENT = (
    "`Stream Event Key` BIGINT, `Date Key` INT, `Customer Key` BIGINT, `Content Key` BIGINT, "
    "`Provider Key` BIGINT, `Streams Count` BIGINT, `Minutes Watched` BIGINT, "
    "`Watch Percentage` DOUBLE, `Completion Flag` BOOLEAN"
)
PAYMENT = (
    "`Payment Key` BIGINT, `Date Key` INT, `Customer Key` BIGINT, `Provider Key` BIGINT, "
    "`Subscription Plan Key` BIGINT, Amount DOUBLE, `Tax Amount` DOUBLE, `Discount Amount` DOUBLE"
)
SUBSCRIPTION = (
    "`Subscription Fact Key` BIGINT, `Date Key` INT, `Customer Key` BIGINT, `Provider Key` BIGINT, "
    "`Plan Key` BIGINT, `Subscription Start Date Key` INT, `Subscription End Date Key` INT, "
    "`Is Active` BOOLEAN, Revenue DOUBLE"
)
AVAILABILITY = (
    "`Catalog Key` BIGINT, `Date Key` INT, `Content Key` BIGINT, `Provider Key` BIGINT, "
    "`License Start Date Key` INT, `License End Date Key` INT, `Is Available` BOOLEAN, "
    "`Catalog Rank Score` DOUBLE"
)

# Names under which a stored table may be found, in order of preference.
TABLE_NAMES = {
    "category": ["categoria", "DimCategory"],
    "content": ["contenido", "DimContent"],
    "content_category": ["contenidocategoria", "dimContentCategory"],
    "content_talent": ["contenidotalento", "dimContentTalent"],
    "customer": ["cliente", "clientes", "customer", "DimCustomer"],
    "date": ["fecha", "DimDate"],
    "geography": ["geografia", "DimGeography"],
    "language": ["lenguaje", "DimLanguage"],
    "payment_method": ["metodopago", "dimPaymentMethod"],
    "provider": ["proveedor", "dimProvider"],
    "plan": ["plansuscripcion", "dimSuscriptionPlan"],
    "talent": ["talento", "dimTalent"],
    "availability": ["catalogodisponible", "FacCatalogAvailability", "dimCatalogAvailability"],
    "payment": ["pagos", "FactPayment"],
    "event": ["eventostreaming", "eventos_streaming", "streamingevent", "FactStreamingEvent"],
    "subscription": ["suscripcion", "FactSuscription"],
    "catalog": ["catalogo", "catalog"],
}

SCHEMAS = {
    "category": CATEGORY,
    "content": CONTENT,
    "content_category": CONTENT_CATEGORY,
    "content_talent": CONTENT_TALENT,
    "customer": CUSTOMER,
    "geography": GEOGRAPHY,
    "language": LANGUAGE,
    "payment_method": PAYMENT_METHOD,
    "provider": PROVIDER,
    "plan": PLAN,
    "talent": TALENT,
    "availability": AVAILABILITY,
    "payment": PAYMENT,
    "event": EVENT,
    "subscription": SUBSCRIPTION,
}

# Column spellings accepted for event tables.
EVENT_ALIASES = {
    "Customer_Key": ["Customer Key", "Customer_Key", "customer_key", "customerKey"],
    "Content_Key": ["Content Key", "Content_Key", "content_key", "contentKey"],
    "Minutes_Watched": ["Minutes Watched", "Minutes_Watched", "minutes_watched", "minutesWatched"],
    "Streams_Count": ["Streams Count", "Streams_Count", "streamsCount", "streams_count"],
}
