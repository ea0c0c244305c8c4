"""Names, weights, rates and limits that results depend on."""

import datetime

# Provinces with weight and cities.
PROVINCES = {
    "تهران": (0.15, ["تهران", "ری", "شهریار", "ورامین"]),
    "اصفهان": (0.08, ["اصفهان", "کاشان", "نجف‌آباد", "خمینی‌شهر"]),
    "فارس": (0.07, ["شیراز", "مرودشت", "کازرون", "لامرد"]),
    "خراسان رضوی": (0.06, ["مشهد", "نیشابور", "سبزوار", "تربت حیدریه"]),
    "خوزستان": (0.06, ["اهواز", "آبادان", "خرمشهر", "دزفول"]),
    "مازندران": (0.05, ["ساری", "بابل", "آمل", "قائمشهر"]),
    "گیلان": (0.04, ["رشت", "بندر انزلی", "لاهیجان", "رودسر"]),
    "آذربایجان شرقی": (0.05, ["تبریز", "مراغه", "اهر", "بناب"]),
    "کرمان": (0.04, ["کرمان", "رفسنجان", "بم", "سیرجان"]),
    "البرز": (0.04, ["کرج", "نظرآباد", "طالقان", "اشتهارد"]),
}

# Remote cities and their provinces.
REMOTE_CITIES = ["چابهار", "زاهدان", "زابل", "بندر عباس", "میناب", "کنگان", "بندر لنگه", "جاسک"]
SISTAN_CITIES = ["چابهار", "زاهدان", "زابل"]
SISTAN = "سیستان و بلوچستان"
HORMOZGAN = "هرمزگان"
FALLBACK_CITY = "تهران"

# Card types with weight and amount multiplier.
CARDS = {
    "پیش‌پرداخت": (0.15, 0.6),
    "جاری": (0.35, 1.0),
    "قرض‌الحسنه": (0.25, 0.8),
    "اعتباری": (0.20, 1.3),
    "طلایی": (0.05, 2.0),
}

# Devices with weight.
DEVICES = {
    "موبایل_اندروید": 0.45,
    "موبایل_iOS": 0.25,
    "وب_دسکتاپ": 0.15,
    "ATM": 0.10,
    "POS": 0.05,
}

# Time span, rates and limits.
START_DATE = datetime.date(2024, 1, 1)
END_DATE = datetime.date(2024, 1, 31)
REFERENCE_YEAR = 2024
NOISE_RATES = {"location": 0.02, "age_amount": 0.005, "time": 0.01, "amount": 0.003}
AGE_MIN, AGE_MAX = 18, 80
AMOUNT_MIN, AMOUNT_MAX = 1000.0, 50_000_000.0
AMOUNT_LOG_MEAN, AMOUNT_LOG_SIGMA = 4.5, 1.2
DAILY_RATE = 3.0
ROWS_PER_USER = (20, 2000)
NOISY_AGES = [16, 17, 85, 90, 95]
NOISE_LABELS = ["location_anomaly", "age_amount_mismatch", "time_pattern_anomaly", "amount_outlier"]

# Feature lists of the detectors and of the similarity search.
ANOMALY_FEATURES = [
    "total_amount", "avg_transaction_amount", "total_transactions",
    "transaction_frequency", "age", "geographical_diversity",
    "night_transaction_ratio", "weekend_transaction_ratio",
    "card_type_diversity", "device_type_diversity",
    "amount_skewness", "amount_iqr", "regularity_score",
]
SIMILARITY_FEATURES = [
    "total_amount", "avg_transaction_amount", "total_transactions",
    "transaction_frequency", "age", "geographical_diversity",
    "night_transaction_ratio", "weekend_transaction_ratio",
    "card_type_diversity", "device_type_diversity",
    "regularity_score", "amount_skewness",
]
