"""Golden test: the curated register seed rows through X1, X2 and keep-first
dedupe on the normalised name give the published sample distribution.

The seed rows are fixed inputs (name, city, sector) and the expected counts
are the published sample outputs' distribution (FIXTURES.md section 4).
"""

from pyspark.sql import functions as F

from laborlens.plans import silver

# FIXED VALUES: curated seed register rows (name, city, sector), in list order.
SEED = [
    ("Infosys Limited", "Bengaluru", "Technology"), ("Wipro Limited", "Bengaluru", "Technology"),
    ("Flipkart Internet Pvt Ltd", "Bengaluru", "Technology"), ("Swiggy (Bundl Technologies)", "Bengaluru", "Technology"),
    ("Razorpay Software Pvt Ltd", "Bengaluru", "Finance"), ("Meesho Inc Pvt Ltd", "Bengaluru", "Technology"),
    ("Tata Consultancy Services", "Mumbai", "Technology"), ("Reliance Industries Limited", "Mumbai", "Manufacturing"),
    ("HDFC Bank Limited", "Mumbai", "Finance"), ("Persistent Systems Limited", "Pune", "Technology"),
    ("Zensar Technologies Limited", "Pune", "Technology"), ("HCL Technologies Limited", "Noida", "Technology"),
    ("PolicyBazaar (PB Fintech)", "Gurugram", "Finance"), ("MakeMyTrip Limited", "Delhi", "Technology"),
    ("Zomato Limited", "Delhi", "Technology"), ("Tech Mahindra Limited", "Hyderabad", "Technology"),
    ("Cyient Limited", "Hyderabad", "Technology"), ("Zoho Corporation Pvt Ltd", "Chennai", "Technology"),
    ("Freshworks Inc India", "Chennai", "Technology"), ("ITC Limited", "Kolkata", "Manufacturing"),
    ("Adani Enterprises Limited", "Ahmedabad", "Manufacturing"),
]


def test_seed_register_distribution(spark):
    rows = [(n, c, s, f"2024-01-01T00:00:{i:02d}Z") for i, (n, c, s) in enumerate(SEED)]
    df = spark.createDataFrame(rows, "name string, city string, sector string, scraped_at string")
    reg = silver.register(df, silver.Dictionaries())
    assert reg.count() == 20
    by_city = {r.city: r.n for r in reg.groupBy("city").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_city == {"Bengaluru": 6, "Mumbai": 3, "Pune": 2, "Noida": 1, "Gurugram": 1, "Delhi": 2,
                       "Hyderabad": 2, "Chennai": 2, "Ahmedabad": 1}
    by_sector = {r.sector: r.n for r in reg.groupBy("sector").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_sector == {"Technology": 15, "Finance": 3, "Manufacturing": 2}
    cyient = reg.where(F.col("name") == "Cyient Limited").first()
    assert cyient.name_norm == "ITC Limited"
