"""Column vocabularies and CSV options of the business-listing feed."""

from __future__ import annotations

# Columns the feature table keeps when the file has them, in output order.
# The feed's own identifier column comes first and is named by the caller (see wanted_columns).
WANTED_COLUMNS = [
    "Address", "City Name", "State Code", "County Name", "Zip Code",
    "Contact Person Name", "Contact Person Position", "Gender Contact Person 2",
    "Employee Count", "Employee Range", "Annual Revenues", "Sales Range",
    "Category",
    "Latitude", "Longitude", "Physical Neighborhood",
    "Love Score", "Freshness Score", "Holistic Score",
    "Reviews Scanned", "Good Reviews Scanned", "Average Review Rating",
    "Likes Count", "Social Media Profiles Count",
    "HQ_Followers", "HQ_Type", "HQ_Employees", "HQ_Name", "HQ_YearFounded",
    "HQ_Categories", "HQ_Specialties", "HQ_Revenue", "HQ_Ticker", "HQ_Exchange",
    "HQ_Acquisitions", "HQ_GrowthScore", "HQ_EstMonthlyUniques", "HQ_EstInboundLinks",
    "HQ_TwitterFollowers", "HQ_FacebookLikes", "HQ_FacebookTalkingAbout", "HQ_LinkedInFollowerCount",
    "Additional Attribute Count", "Photos Captured Count", "Year Founded",
    "Verified", "Confirmed Verification Done", "Bucket", "Source",
    "Contact Person Position 2",
    "8 Digit SIC ( Source1 )", "SIC8 Category Name",
    "6 Digit SIC ( Source2 )", "SIC6 Category Name",
    "SIC ( Source3 )",
    "Credit Rating", "Review Sources",
    "SalesRange Normalized", "EmployeeRange Normalized",
    "HQ SalesRange Normalized", "HQ EmployeeRange Normalized",
    "Price Range Normalized", "Wi Fi Normalized", "Cuisine Normalized", "Parking Normalized",
    "Verified Normalized", "Ambience Normalized", "Location Type Normalized",
    "State of Incorporation Normalized", "Tags Normalized", "By Appointment Only Normalized",
    "Yelp Reviews Count Normalized", "Yelp Photos Count Normalized",
    "Foursquare Average Review Rating Normalized", "Foursquare Reviews Count Normalized",
    "Foursquare Photos Count Normalized", "Foursquare Visitors Normalized",
    "Foursquare Checkins Normalized", "Foursquare Tips Normalized",
    "Facebook Reviews Count Normalized", "Facebook Photos Count Normalized", "Facebook Visitors Normalized",
    "GooglePlaces Reviews Count Normalized", "GooglePlaces Photos Count Normalized",
    "CitySearch Reviews Count Normalized", "CitySearch Photos Count Normalized",
    "User Count Normalized", "Number of Votes on FourSquare Normalized",
    "# of PeopleTalking on Facebook", "# of Likes on Facebook",
    "Tweets Count", "Followers Count", "Following Count",
    "Average Review Rating on Google Normalized", "Average Review Rating on CitySearch Normalized",
    "sales",
]

# Columns the importer requires, in output order.
IMPORT_COLUMNS = [
    "Address", "City Name", "State Code", "County Name", "Zip Code",
    "Contact Person Name", "Contact Person Position", "Gender Contact Person 2",
    "Employee Count", "Employee Range", "Annual Revenues", "Sales Range",
    "SIC Name / Category", "Category", "Full Category Set",
    "Latitude", "Longitude", "Physical Neighborhood",
    "Love Score", "Freshness Score", "Holistic Score",
    "Hours of Operation",
    "Reviews Scanned", "Good Reviews Scanned", "Average Review Rating",
    "Likes Count", "Social Media Profiles Count",
    "Facebook Profile", "Twitter Profile", "Foursquare Profile",
    "HQ_Followers", "HQ_Type", "HQ_Employees", "HQ_Name", "HQ_YearFounded",
    "HQ_Categories", "HQ_Specialties", "HQ_Revenue", "HQ_Ticker", "HQ_Exchange",
    "HQ_Acquisitions", "HQ_GrowthScore", "HQ_EstMonthlyUniques", "HQ_EstInboundLinks",
    "HQ_TwitterFollowers", "HQ_FacebookLikes", "HQ_FacebookTalkingAbout", "HQ_LinkedInFollowerCount",
]

# Labels searched for in the feed's text columns, payment words, target and category columns.
REVIEW_MARKER = "Source:"
PAYMENT_LABEL = "Payment Methods:"
PAYMENT_METHODS = ["visa", "master", "cash", "debit", "check", "amex", "financing"]
TARGET_COLUMN = "sales"
CATEGORY_COLUMN = "Category"
CATEGORY_VECTOR = "CategoryVector"

# Names of files that are complete and ready, matched against the whole path.
IN_PATTERN = r"/in/[0-9a-z\-]{1,}\.csv"
OUT_PATTERN = r"/out/[0-9a-z\-]{1,}\.csv"

SOURCE_FILE = "source_file"

# Options that must be equal on write and read for a file to come back unchanged.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def wanted_columns(id_column: str | None = None) -> list[str]:
    """The wanted columns, led by the feed's identifier column when the caller names one."""
    return ([id_column] if id_column else []) + WANTED_COLUMNS
