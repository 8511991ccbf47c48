"""Declared schemas. Columns go by name; spreadsheets' positions end at the reader."""

from __future__ import annotations

# The wide table, a row a doctor. Header, our name, type, grain (p: practice, d: doctor).
WIDE = [
    ("Index", "idx", "int", "p"), ("Practice Name", "practice_name", "string", "p"), ("Doctor Name", "doctor_name", "string", "d"), ("Address", "street", "string", "p"),
    ("City", "city", "string", "p"), ("State", "state", "string", "p"), ("Zip", "zip", "string", "p"), ("Practice Website", "website", "string", "p"), ("Practice Email", "email", "string", "p"),
    ("# of Hygienists", "hygienists", "int", "p"),
    ("Facebook URL", "facebook_url", "string", "p"), ("FB # Posts", "facebook_posts", "string", "p"), ("FB Followers", "facebook_followers", "string", "p"),
    ("Instagram URL", "instagram_url", "string", "p"), ("IG # Posts", "instagram_posts", "string", "p"), ("IG Followers", "instagram_followers", "string", "p"),
    ("TikTok URL", "tiktok_url", "string", "p"), ("TT # Posts", "tiktok_posts", "string", "p"), ("TT Followers", "tiktok_followers", "string", "p"),
    ("LinkedIn URL", "linkedin_url", "string", "p"), ("LI # Posts", "linkedin_posts", "string", "p"), ("LI Followers", "linkedin_followers", "string", "p"),
    ("CEREC (Same Day Crowns)", "cerec", "boolean", "p"), ("CBCT (3D Imaging)", "cbct", "boolean", "p"), ("Lasers", "lasers", "boolean", "p"), ("AI", "ai", "boolean", "p"), ("Intraoral Scanners", "intraoral", "boolean", "p"),
    ("Invisalign (Mentions)", "invisalign", "int", "p"), ("Invisalign Tier (check manually)", "invisalign_tier", "string", "p"), ("Clear Aligners", "clear_aligners", "int", "p"), ("Veneers", "veneers", "int", "p"),
    ("Implants", "implants", "int", "p"), ("Smile Makeovers", "smile_makeovers", "int", "p"), ("Teeth Whitening", "whitening", "int", "p"), ("Sedation Dentistry", "sedation", "int", "p"), ("Holistic Dentistry", "holistic", "int", "p"),
    ("Dental Plan (Membership Plan)", "dental_plan", "string", "p"), ("Cancer Screening", "cancer_screening", "int", "p"), ("# of Locations", "locations_count", "string", "p"),
    ("Associations / Memberships", "associations", "string", "d"), ("Doctor Specialty", "specialty", "string", "d"),
    ("Google Reviews Ranking", "google_rating", "double", "p"), ("Total # of Google Reviews", "google_reviews", "int", "p"), ("Yelp Rating", "yelp_rating", "double", "p"), ("Total # of Yelp Reviews", "yelp_reviews", "int", "p"), ("Testimonials (Number of)", "testimonials", "int", "p"),
]
WIDE_DDL = ", ".join(f"{name} {kind}" for _, name, kind, _ in WIDE)
DOCTOR_COLUMNS = [name for _, name, _, grain in WIDE if grain == "d"]
FLAGS = ["cerec", "cbct", "lasers", "ai", "intraoral"]
COUNTS = ["invisalign", "clear_aligners", "veneers", "implants", "smile_makeovers", "whitening", "sedation", "holistic", "cancer_screening"]

PRACTICE = "idx int, practice_name string, doctor_name string, street string, city string, state string, zip string, website string"
# Other headers of the same columns.
ALIASES = {"idx": ["ID", "Index", "#"], "practice_name": ["Office Name", "Practice Name"], "doctor_name": ["Doctor Name"], "street": ["Street", "Address"], "city": ["City"], "state": ["State"], "zip": ["Zip", "Zip Code"], "website": ["Website", "Practice Website"]}
PAGE = "practice_id int, page_type string, url string, html string, saved_at string, page_ord int"
DOCTOR = "struct<name:string,specialty:string,associations:array<string>>"
RESULT = f"practice struct<{PRACTICE.replace(' ', ':').replace(',:', ',')}>, scraped_at string, result map<string,string>, doctors array<{DOCTOR}>"
MANIFEST = "pages map<string,struct<url:string,file:string,saved_at:string>>"
SKIPPED = ["idx", "practice_name", "doctor_name", "city", "state", "website", "skip_reason"]
NPI = "number string, basic struct<first_name:string,last_name:string,credential:string,status:string>, addresses array<struct<address_purpose:string,address_1:string,city:string,state:string,postal_code:string,telephone_number:string,organization_name:string>>, taxonomies array<struct<desc:string>>"
PLACES = "idx int, candidates array<struct<place_id:string,formatted_address:string,rating:double,user_ratings_total:int>>"
CHAIN = ["idx", "practice_name", "doctor_name", "street", "city", "state", "zip", "website", "phone", "invisalign", "veneers", "implants", "whitening", "google_rating", "google_reviews", "associations", "specialty"]

# Quality analysis, field by tier, in the order of reports.
QA_SPEC = (
    [(f, "critical") for f in ("doctor_name", "email", "google_rating", "google_reviews")]
    + [(f, "important") for f in ("hygienists", "facebook_url", "associations", "specialty")]
    + [(f, "optional") for f in ("instagram_url", "tiktok_url", "linkedin_url", "yelp_rating", "yelp_reviews", "testimonials", "locations_count")]
    + [(f"{site}_{n}", "info") for site in ("facebook", "instagram", "tiktok", "linkedin") for n in ("posts", "followers")]
    + [(f, "tech") for f in FLAGS]
    + [("invisalign", "service"), ("invisalign_tier", "info")]
    + [(f, "service") for f in ("clear_aligners", "veneers", "implants", "smile_makeovers", "whitening", "sedation", "holistic", "dental_plan", "cancer_screening")]
)
HEADERS = {name: header for header, name, _, _ in WIDE}
