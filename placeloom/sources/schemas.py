"""Schemas of the sources and of the venue table."""

TAGS = "map<string,string>"
MAP_ELEMENT = f"type string, id bigint, lat double, lon double, center struct<lat: double, lon: double>, tags {TAGS}"
REGISTER = "FHRSID bigint, BusinessName string, BusinessTypeID int, AddressLine1 string, AddressLine2 string, AddressLine3 string, PostCode string, Phone string, geocode struct<latitude: string, longitude: string>"
PLACE = (
    "id string, names struct<primary: string, common: map<string,string>>, taxonomy struct<hierarchy: array<string>>, websites array<string>, emails array<string>, socials array<string>, "
    "phones array<string>, addresses array<struct<freeform: string, postcode: string>>, confidence double, operating_status string, sources array<struct<dataset: string>>, "
    "bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>, geometry binary"
)
DIVISION = "names struct<primary: string, common: map<string,string>>, region string, country string, subtype string, bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>, geometry binary"
WIKIDATA = "itemLabel struct<value: string>, site struct<value: string>, coord struct<value: string>"
AREA = "borough string, area string, post_town string, districts string"
PARTNER = "name string, district_label string, instagram_handle string, instagram_url string, facebook_page string, facebook_url string, website string, email string, phone string, source_method string, notes string"
PAGE = "url string, final_url string, http_status int, error string, robots_allowed boolean, html string"
CRAWL_LOG = "key string, emails array<string>, status string, final_url string, lang string, v int, pos bigint, _corrupt_record string"
DISCOVERY_LOG = "key string, website string, evidence string, tried int, pos bigint, _corrupt_record string"
MX_LOG = "domain string, status string, pos bigint, _corrupt_record string"
VENUE = (
    f"seq bigint, borough string, admin_district string, area string, name string, name_en string, name_local string, latin_name boolean, tags {TAGS}, email string, email_source string, email_check string, "
    "other_emails array<string>, website string, website_type string, social_website string, phone string, address string, postcode string, facebook string, instagram string, social_url string, osm_url string, "
    "lat double, lon double, source string, categories array<string>, closed boolean, site_language string, english_hint int, english_score int, english_priority string, english string, why string, "
    "locations bigint, merged bigint, partner_notes string"
)
