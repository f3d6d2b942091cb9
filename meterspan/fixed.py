"""They decide results, so they are stated here as plain text."""

# --- readings -------------------------------------------------------------
MISSING_MARK = "?"
RAW_TIME_FORMAT = "d/M/yyyy HH:mm:ss"
MEASURES = [
    "Global_active_power",
    "Global_reactive_power",
    "Voltage",
    "Global_intensity",
    "Sub_metering_1",
    "Sub_metering_2",
    "Sub_metering_3",
]
SUB_METERS = ["Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]
MIN_READINGS_PER_HOUR = 30
INTERPOLATION_LIMIT = 60

# --- daily and hourly tables ----------------------------------------------
ROLLUP_COLUMNS = [
    "energy_kwh",
    "avg_voltage",
    "avg_intensity",
    "avg_reactive_power",
    "sub_metering_1",
    "sub_metering_2",
    "sub_metering_3",
]
DATE_SHIFT_DAYS = 5844
SHIFTED_START = "2022-12-16"
HOURLY_SPLIT_DATE = "2010-01-01"

# --- model inputs ---------------------------------------------------------
CALENDAR_FEATURES = [
    "year",
    "month",
    "day",
    "day_of_week",
    "day_of_year",
    "week_of_year",
    "quarter",
    "is_weekend",
    "season",
]
LAGS = [1, 2, 3, 7, 14, 21, 30]
ROLLING_WINDOWS = [3, 7, 14, 30]
EWM_SPANS = [7, 30]
LAG_FEATURES = [f"lag_{n}" for n in LAGS]
ROLLING_MEAN_FEATURES = [f"rolling_mean_{n}" for n in ROLLING_WINDOWS]
ROLLING_STD_FEATURES = [f"rolling_std_{n}" for n in ROLLING_WINDOWS]
EWM_FEATURES = [f"ewm_{n}" for n in EWM_SPANS]
DAILY_FEATURES = (
    CALENDAR_FEATURES + LAG_FEATURES + ROLLING_MEAN_FEATURES + ROLLING_STD_FEATURES + EWM_FEATURES
)
HOURLY_FEATURES = [
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "lag_1h",
    "lag_24h",
    "rolling_avg_3h",
    "rolling_avg_24h",
    "avg_voltage",
    "avg_intensity",
    "avg_reactive_power",
    "sub_metering_1",
    "sub_metering_2",
    "sub_metering_3",
]
ANOMALY_FEATURES = ["energy_kwh", "rolling_mean_7", "rolling_std_7"]
CLUSTER_FEATURES = ["energy_kwh", "avg_voltage", "avg_intensity", "rolling_mean_7"]
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
CONTEXT_DAYS = 30
MAX_GAP_DAYS = 5
MAX_HORIZON_DAYS = 30
CONTAMINATION = 0.02
LOCAL_ESTIMATE_FACTOR = 0.95

# --- labels ---------------------------------------------------------------
WEEKDAYS_FROM_MONDAY = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKDAYS_FROM_SUNDAY = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]
SEASONS_HOURLY = ["Winter", "Spring", "Summer", "Fall"]

# --- billing and household settings ---------------------------------------
BILLING_DAYS = 30
MAX_BILLING_DAYS = 365
CO2_KG_PER_KWH = 0.79
BILL_REASONS = {
    "daily": "Predicted consumption must be greater than zero.",
    "tariff": "Tariff must be greater than zero.",
    "days": "Billing period must be a whole number of days between 1 and 365.",
    "fixed": "Standing charge cannot be negative.",
}
# name -> (default, lowest, highest); text fields carry a maximum length.
HOUSEHOLD_NUMBERS = {
    "household_members": (1.0, 1.0, 20.0),
    "electricity_tariff": (8.0, 0.5, 50.0),
    "fixed_charges": (120.0, 0.0, 5000.0),
    "bill_alert": (1500.0, 100.0, 50000.0),
    "carbon_intensity": (0.79, 0.1, 2.0),
    "billing_days": (30.0, 1.0, 31.0),
}
HOUSEHOLD_TEXTS = {"name": ("My Home", 120), "property_type": ("3 BHK Apartment", 80)}
# Application settings and their defaults.
SETTINGS_TEXTS = {
    "userName": "Homeowner",
    "userEmail": "",
    "householdName": "My Home",
    "propertyType": "3 BHK Apartment",
    "currency": "INR",
}
SETTINGS_NUMBERS = {
    "householdMembers": 4.0,
    "electricityTariff": 8.0,
    "fixedCharges": 120.0,
    "billAlert": 1500.0,
    "dataPeriod": 30.0,
    "carbonIntensity": 0.79,
    "billingDays": 30.0,
}
SETTINGS_NOTIFICATIONS = {"anomalies": True, "weekly": True, "bill": True}

# --- anomaly reports ------------------------------------------------------
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
CAUSES = [
    (40.0, "Base Load Drift", "Sustained standby or base-load creep above the rolling window."),
    (
        120.0,
        "Thermal Duty Cycle",
        "Cooling or heating equipment running longer than the recent baseline.",
    ),
    (
        300.0,
        "Multi-Appliance Surge",
        "Several heavy loads ran concurrently, pushing the day well past its 7-day average.",
    ),
    (
        None,
        "Extreme Outlier",
        "Consumption was far outside recent norms. Possible contributing factors could include an "
        "extended appliance cycle, an unattended load, or an unusual occupancy pattern. Verify "
        "against meter readings before drawing conclusions.",
    ),
]
LOW_USAGE_CATEGORY = "Low Usage / Absence"
LOW_USAGE_CAUSE = (
    "Possible explanation: Extended vacancy, a power interruption or a thermostat shut-down are "
    "common scenarios."
)
ACTION_HIGH = (
    "Open the sub-circuit for the day, identify the highest-wattage device, and re-run this window "
    "with a shorter duty cycle."
)
ACTION_LOW = (
    "Confirm the meter read and check that always-on loads (fridge, router, geyser pilot) are "
    "behaving normally."
)
USAGE_STATUS = [
    (-10.0, "Great — lower than usual"),
    (5.0, "Usage looks stable & healthy"),
    (20.0, "Slightly higher than usual"),
    (None, "Noticeable usage spike"),
]

# --- appliances and what-if -----------------------------------------------
APPLIANCE_TYPES = [
    "ac",
    "fridge",
    "tv",
    "washing_machine",
    "water_heater",
    "fan",
    "lights",
    "kitchen",
    "laptop",
    "ev",
    "heater",
    "generic",
]
DEFAULT_APPLIANCES = [
    ("a1", "Air Conditioner (Inverter)", "ac", 1500.0, 1.0, 8.0, 6.0, 30.0),
    ("a2", "Frost-Free Refrigerator", "fridge", 200.0, 1.0, 24.0, 24.0, 30.0),
    ("a3", 'Smart TV (55" 4K)', "tv", 120.0, 1.0, 5.0, 3.5, 30.0),
    ("a4", "Front Load Washing Machine", "washing_machine", 500.0, 1.0, 1.5, 1.0, 20.0),
    ("a5", "Water Heater / Geyser", "water_heater", 2000.0, 1.0, 2.0, 1.2, 30.0),
    ("a6", "Ceiling Fans", "fan", 75.0, 4.0, 12.0, 9.0, 30.0),
    ("a7", "LED Lights (15W each)", "lights", 15.0, 10.0, 6.0, 4.5, 30.0),
]
# Preset rules as data: per type an absolute hour count ("set"), a number of
# hours off with a floor ("minus"), or a factor with a floor ("times").  The
# type "*" covers every other type; "keep" leaves the proposed hours alone.
PRESET_RULES = [
    ("ac", "ac", "minus", 2.0, 1.0),
    ("ac", "*", "keep", None, None),
    ("efficient", "ac", "set", 5.0, None),
    ("efficient", "water_heater", "set", 1.0, None),
    ("efficient", "tv", "set", 3.0, None),
    ("efficient", "fan", "set", 8.0, None),
    ("efficient", "lights", "set", 4.0, None),
    ("efficient", "washing_machine", "set", 0.8, None),
    ("efficient", "*", "times", 0.75, 0.5),
    ("standby", "tv", "times", 0.7, 0.0),
    ("standby", "lights", "times", 0.8, 0.0),
    ("standby", "*", "keep", None, None),
    ("vacation", "fridge", "set", 24.0, None),
    ("vacation", "lights", "set", 3.0, None),
    ("vacation", "fan", "set", 6.0, None),
    ("vacation", "tv", "set", 2.0, None),
    ("vacation", "water_heater", "set", 0.8, None),
    ("vacation", "ac", "set", 3.0, None),
    ("vacation", "washing_machine", "set", 0.5, None),
    ("vacation", "*", "keep", None, None),
    ("reset", "*", "times", 1.0, 0.0),
]
MIN_RANKED_SAVING = 0.5

# --- recommendations ------------------------------------------------------
# id, category, monthly kWh, impact, difficulty, target type, target hours
RECOMMENDATIONS = [
    ("rec-ac-hours", "Cooling", 45.0, "High", "Very Easy", "ac", 6.0),
    ("rec-geyser", "Heating", 48.0, "High", "Very Easy", "water_heater", 1.2),
    ("rec-standby", "Standby", 24.0, "Medium", "Very Easy", "tv", 3.5),
    ("rec-laundry", "Appliances", 15.0, "Medium", "Easy", "washing_machine", 1.0),
    ("rec-fans", "Cooling", 36.0, "Medium", "Easy", "fan", 9.0),
    ("rec-fridge", "Appliances", 32.0, "Medium", "Medium", "fridge", 24.0),
    ("rec-lighting", "Lighting", 18.0, "Low", "Medium", "lights", 4.5),
    ("rec-scheduling", "Timing", 28.0, "Medium", "Easy", "washing_machine", 1.5),
]
IMPACT_SCORE = {"High": 3, "Medium": 2, "Low": 1}
DIFFICULTY_SCORE = {"Very Easy": 1, "Easy": 2, "Medium": 3, "Hard": 4}

# --- forecast presets -----------------------------------------------------
# id, window, scale, offset of the target date in days
FORECAST_PRESETS = [
    ("benchmark", "test_split", 1.0, 0),
    ("history", "tail", 1.0, 0),
    ("summer", "test_split", 1.55, 30),
    ("eco", "test_split", 0.6, -90),
]
