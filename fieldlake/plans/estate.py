"""The estate: seven sources, six models, six serving tables and the master data, as data."""

from fieldlake.contracts import ModelSpec, Range, ServingContract, SourceContract

# Names, order and types of the source columns, keys, cleaning rules and plausible
# ranges. They are the interface of the data and must be exactly these.

WEATHER = SourceContract(
    name="weather",
    file_name="weather_observations.csv",
    columns="""
        timestamp string, station_id string, region_id string, temperature_c double,
        humidity_pct double, rainfall_mm double, wind_speed_kmh double,
        weather_condition string, pressure_hpa double
    """,
    key=("station_id", "timestamp"),
    required=("station_id", "timestamp"),
    retyped={"timestamp": "timestamp"},
    codes=("station_id", "region_id", "weather_condition"),
    ranges=(
        Range("temperature_c", -10, 50),
        Range("humidity_pct", 0, 100),
        Range("rainfall_mm", 0),
        Range("wind_speed_kmh", 0),
        Range("pressure_hpa", 900, 1100),
    ),
)

HARVEST = SourceContract(
    name="harvest",
    file_name="harvest_transactions.csv",
    columns="""
        harvest_id string, timestamp string, block_id string, crop_type string,
        employee_id string, equipment_id string, harvested_weight_kg double,
        quality_grade string, moisture_pct double, collection_duration_minutes int,
        destination string, status string
    """,
    key=("harvest_id",),
    required=("harvest_id", "timestamp"),
    retyped={"timestamp": "timestamp"},
    blanks=("equipment_id", "destination"),
    codes=("harvest_id", "block_id", "crop_type", "employee_id", "quality_grade", "status"),
    ranges=(
        Range("harvested_weight_kg", 0),
        Range("moisture_pct", 0, 100),
        Range("collection_duration_minutes", 0),
    ),
)

FERTILIZER = SourceContract(
    name="fertilizer",
    file_name="fertilizer_applications.csv",
    columns="""
        application_id string, timestamp string, block_id string, crop_type string,
        employee_id string, material_id string, quantity_kg double,
        application_method string, equipment_id string, weather_station_id string,
        weather_condition string, rainfall_mm double, application_status string,
        notes string
    """,
    key=("application_id",),
    required=("application_id", "timestamp"),
    retyped={"timestamp": "timestamp"},
    blanks=("equipment_id", "notes", "weather_station_id"),
    codes=(
        "application_id",
        "block_id",
        "crop_type",
        "material_id",
        "employee_id",
        "application_method",
        "application_status",
    ),
    ranges=(Range("quantity_kg", 0), Range("rainfall_mm", 0)),
    free_text=True,
)

EQUIPMENT = SourceContract(
    name="equipment",
    file_name="equipment_logs.csv",
    columns="""
        operation_id string, timestamp string, equipment_id string, equipment_type string,
        block_id string, operator_id string, operation_type string, start_time string,
        end_time string, duration_minutes int, engine_hours double,
        fuel_consumption_liters double, distance_km double, maintenance_flag boolean,
        maintenance_type string, status string
    """,
    key=("operation_id",),
    required=("operation_id", "timestamp"),
    retyped={"timestamp": "timestamp", "start_time": "timestamp", "end_time": "timestamp"},
    blanks=("block_id", "operator_id", "maintenance_type"),
    codes=("operation_id", "equipment_id", "equipment_type", "operation_type", "status"),
    ranges=(
        Range("duration_minutes", 0),
        Range("engine_hours", 0),
        Range("fuel_consumption_liters", 0),
        Range("distance_km", 0),
    ),
)

HR = SourceContract(
    name="hr",
    file_name="hr_attendance.csv",
    columns="""
        attendance_id string, employee_id string, employee_name string, role string,
        department string, cost_center_id string, attendance_date string, shift string,
        check_in_time string, check_out_time string, working_hours double,
        overtime_hours double, attendance_status string, leave_type string,
        work_location string, remarks string
    """,
    key=("attendance_id",),
    required=("attendance_id", "attendance_date"),
    retyped={"attendance_date": "date"},
    blanks=("leave_type", "remarks", "check_in_time", "check_out_time"),
    codes=("attendance_id", "employee_id", "cost_center_id", "shift", "attendance_status"),
    trims=("employee_name", "role", "department"),
    ranges=(Range("working_hours", 0, 24), Range("overtime_hours", 0, 24)),
    free_text=True,
)

FINANCE = SourceContract(
    name="finance",
    file_name="sap_finance_transactions.csv",
    columns="""
        document_id string, posting_date string, posting_timestamp string, fiscal_year int,
        fiscal_period int, company_code string, cost_center_id string, gl_account string,
        transaction_type string, reference_document string, employee_id string,
        equipment_id string, material_id string, amount double, currency string,
        debit_credit_indicator string, description string
    """,
    key=("document_id", "debit_credit_indicator", "gl_account"),
    required=("document_id", "posting_date"),
    retyped={"posting_date": "date", "posting_timestamp": "timestamp", "amount": "decimal(18,2)"},
    blanks=("reference_document", "employee_id", "equipment_id", "material_id"),
    codes=(
        "document_id",
        "company_code",
        "cost_center_id",
        "transaction_type",
        "debit_credit_indicator",
        "currency",
    ),
    trims=("gl_account",),
    ranges=(Range("amount", 0), Range("fiscal_period", 1, 16)),
)

SENSORS = SourceContract(
    name="sensors",
    file_name="",
    columns="""
        timestamp string, block_id string, sensor_id string, soil_moisture_pct string,
        soil_temperature_c string, air_temperature_c string, humidity_pct string,
        soil_ph string, light_intensity_lux string, battery_level_pct string,
        sensor_status string
    """,
    key=("sensor_id", "timestamp"),
    required=("sensor_id", "timestamp"),
    retyped={
        "timestamp": "timestamp",
        "soil_moisture_pct": "double",
        "soil_temperature_c": "double",
        "air_temperature_c": "double",
        "humidity_pct": "double",
        "soil_ph": "double",
        "light_intensity_lux": "double",
        "battery_level_pct": "double",
    },
    blanks=("sensor_id",),
    codes=("block_id", "sensor_id", "sensor_status"),
)

BATCH_SOURCES = {c.name: c for c in (WEATHER, HARVEST, FERTILIZER, EQUIPMENT, HR, FINANCE)}

DIM_EQUIPMENT = ModelSpec(
    name="dim_equipment",
    source="equipment",
    key=("equipment_id",),
    required=("equipment_id",),
    columns={"equipment_id": "equipment_id", "equipment_type": "equipment_type"},
    latest_by="timestamp",
)

DIM_EMPLOYEE = ModelSpec(
    name="dim_employee",
    source="hr",
    key=("employee_id",),
    required=("employee_id",),
    columns={
        name: name for name in ("employee_id", "employee_name", "role", "department", "cost_center_id")
    },
    latest_by="attendance_date",
)

FACT_HARVEST = ModelSpec(
    name="fact_harvest",
    source="harvest",
    key=("harvest_id",),
    required=("harvest_id",),
    columns={
        "harvest_id": "harvest_id",
        "harvest_date": "to_date(`timestamp`)",
        "harvest_timestamp": "`timestamp`",
        "block_id": "block_id",
        "crop_type": "crop_type",
        "employee_id": "employee_id",
        "equipment_id": "equipment_id",
        "harvested_weight_kg": "harvested_weight_kg",
        "quality_grade": "quality_grade",
        "moisture_pct": "moisture_pct",
        "collection_duration_minutes": "collection_duration_minutes",
        "destination": "destination",
        "status": "status",
    },
    event_date="harvest_date",
)

FACT_REVENUE = ModelSpec(
    name="fact_revenue",
    source="finance",
    key=FINANCE.key,
    required=("document_id",),
    columns={name: name for name in FINANCE.column_names if name != "posting_timestamp"},
    event_date="posting_date",
)

FACT_FERTILIZER = ModelSpec(
    name="fact_fertilizer",
    source="fertilizer",
    key=("application_id",),
    required=("application_id",),
    columns={
        "application_id": "application_id",
        "application_date": "to_date(`timestamp`)",
        "application_timestamp": "`timestamp`",
        "block_id": "block_id",
        "crop_type": "crop_type",
        "employee_id": "employee_id",
        "material_id": "material_id",
        "quantity_kg": "quantity_kg",
        "application_method": "application_method",
        "equipment_id": "equipment_id",
        "weather_station_id": "weather_station_id",
        "rainfall_mm": "rainfall_mm",
        "application_status": "application_status",
    },
    event_date="application_date",
)

FACT_EQUIPMENT = ModelSpec(
    name="fact_equipment",
    source="equipment",
    key=("operation_id",),
    required=("operation_id",),
    columns={
        "operation_id": "operation_id",
        "operation_date": "to_date(`timestamp`)",
        "operation_timestamp": "`timestamp`",
        "equipment_id": "equipment_id",
        "equipment_type": "equipment_type",
        "block_id": "block_id",
        "operator_id": "operator_id",
        "operation_type": "operation_type",
        "duration_minutes": "duration_minutes",
        "engine_hours": "engine_hours",
        "fuel_consumption_liters": "fuel_consumption_liters",
        "distance_km": "distance_km",
        "maintenance_flag": "maintenance_flag",
        "maintenance_type": "maintenance_type",
        "status": "status",
    },
    event_date="operation_date",
)

MODELS = {
    m.name: m
    for m in (DIM_EQUIPMENT, DIM_EMPLOYEE, FACT_HARVEST, FACT_REVENUE, FACT_FERTILIZER, FACT_EQUIPMENT)
}

# SQL types of the serving tables.
SERVING = {
    c.name: c
    for c in (
        ServingContract(
            "dim_equipment", {"equipment_id": "varchar(50)", "equipment_type": "varchar(100)"}
        ),
        ServingContract(
            "dim_employee",
            {
                "employee_id": "varchar(50)",
                "employee_name": "varchar(200)",
                "role": "varchar(100)",
                "department": "varchar(100)",
                "cost_center_id": "varchar(50)",
            },
        ),
        ServingContract(
            "fact_harvest",
            {
                "harvest_id": "varchar(50)",
                "harvest_date": "date",
                "harvest_timestamp": "datetime2",
                "block_id": "varchar(50)",
                "crop_type": "varchar(100)",
                "employee_id": "varchar(50)",
                "equipment_id": "varchar(50)",
                "harvested_weight_kg": "float",
                "quality_grade": "varchar(20)",
                "moisture_pct": "float",
                "collection_duration_minutes": "int",
                "destination": "varchar(100)",
                "status": "varchar(50)",
            },
        ),
        ServingContract(
            "fact_revenue",
            {
                "document_id": "varchar(50)",
                "posting_date": "date",
                "fiscal_year": "int",
                "fiscal_period": "int",
                "company_code": "varchar(20)",
                "cost_center_id": "varchar(50)",
                "gl_account": "varchar(20)",
                "transaction_type": "varchar(100)",
                "reference_document": "varchar(100)",
                "employee_id": "varchar(50)",
                "equipment_id": "varchar(50)",
                "material_id": "varchar(50)",
                "amount": "decimal(18,2)",
                "currency": "varchar(10)",
                "debit_credit_indicator": "varchar(5)",
                "description": "varchar(500)",
            },
        ),
        ServingContract(
            "fact_fertilizer",
            {
                "application_id": "varchar(50)",
                "application_date": "date",
                "application_timestamp": "datetime2",
                "block_id": "varchar(50)",
                "crop_type": "varchar(100)",
                "employee_id": "varchar(50)",
                "material_id": "varchar(50)",
                "quantity_kg": "float",
                "application_method": "varchar(100)",
                "equipment_id": "varchar(50)",
                "weather_station_id": "varchar(50)",
                "rainfall_mm": "float",
                "application_status": "varchar(50)",
            },
        ),
        ServingContract(
            "fact_equipment",
            {
                "operation_id": "varchar(50)",
                "operation_date": "date",
                "operation_timestamp": "datetime2",
                "equipment_id": "varchar(50)",
                "equipment_type": "varchar(100)",
                "block_id": "varchar(50)",
                "operator_id": "varchar(50)",
                "operation_type": "varchar(100)",
                "duration_minutes": "int",
                "engine_hours": "float",
                "fuel_consumption_liters": "float",
                "distance_km": "float",
                "maintenance_flag": "bit",
                "maintenance_type": "varchar(100)",
                "status": "varchar(50)",
            },
        ),
    )
}

# Master data schemas.
MASTER_SCHEMAS = {
    "stations": "station_id string, region_id string, latitude double, longitude double",
    "crops": "name string, target_yield_per_ha_ton double, optimal_moisture_low double, "
    "optimal_moisture_high double, optimal_temp_low double, optimal_temp_high double",
    "blocks": "id string, crop_type string, area_ha double, region_id string",
    "equipment": "id string, type string",
    "materials": "id string, category string, standard_cost double",
    "cost_centers": "id string, region_id string, position int",
    "employees": "id string, name string, role string, department string, cost_center_id string",
}
