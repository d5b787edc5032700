"""Column contracts of the raw tables and lookup files."""

from __future__ import annotations


def schema(ddl: str) -> str:
    return " ".join(ddl.split())


# The complaint feed after the wide text column has been replaced by a flag.
COMPLAINTS = schema("""
    complaint_id string, date_received date, date_sent_to_company date,
    product string, subproduct string, issue string, subissue string, company_name string,
    state string, zip_code string, tags string, submitted_via string,
    company_response_to_consumer string, company_public_response string,
    timely_response boolean, consumer_disputed boolean, consumer_consent_provided string,
    has_narrative boolean
""")

# Lookup files.
CROSSWALK = schema("""
    raw_company_name string, canonical_name string, category string,
    fdic_top_holder string, parent_as_of date
""")
PRODUCT_MAP = "raw_product string, product_normalized string"
SUBPRODUCT_MAP = "raw_product string, raw_subproduct string, subproduct_normalized string"
ISSUE_MAP = "issue string, issue_category string"

# The bank reference table, one row per institution, amounts in thousands of USD.
BANKS = schema("""
    fdic_certificate_number string, institution_name string, trade_name_1 string, fdic_id string,
    rssd_id string, ultimate_cert_number string, parent_parcert string,
    active boolean, conservatorship boolean, denovo_institute boolean,
    address string, city string, state string, state_name string, state_fips_code string,
    zip_code string, county_name string, county_fips_code string, cbsa_name string,
    cbsa_fips_code string, cbsa_metro_flag boolean, cbsa_micro_flag boolean,
    cbsa_division_name string, cbsa_division_fips_code string, cbsa_division_flag boolean,
    csa_name string, csa_fips_code string, csa_indicator boolean,
    bank_charter_class string, chartering_agency string, federal_charter boolean,
    state_chartered boolean, occ_charter string, occ_district string, regulator string,
    category_code string, ots_region string, qbp_region string, fdic_geo_region string,
    fdic_supervisory_region string, fdic_supervisory_region_code string, fdic_field_office string,
    fed_reserve_district string, fed_reserve_district_id string, fed_reserve_unique_id string,
    docket string, cfpb_supervisory_flag boolean, cfpb_supervisory_start_date date,
    cfpb_supervisory_end_date date, fdic_insured boolean, deposit_insurance_date date,
    deposit_insurance_fund_member boolean, bank_insurance_fund_member boolean,
    insurance_fund_membership string, secondary_insurance_fund string,
    insured_commercial_bank boolean, insured_savings_institute boolean,
    holding_company_flag boolean, holding_company_state string, high_holder_city string,
    top_holder string, ownership_type boolean, subchap_s_indicator boolean,
    primary_specialization string, asset_concentration_hierarchy string,
    credit_card_institution boolean, ag_lending_flag boolean, trust_powers_status string,
    iba boolean, ffiec_call_report_filer boolean, law_sasser boolean,
    total_assets bigint, total_deposits bigint, total_domestic_deposits bigint,
    equity_capital bigint, net_income bigint, quarterly_net_income bigint,
    return_on_assets double, roa_quarterly double, roa_pretax double, row_pretax_quarterly double,
    return_on_equity double, roe_quarterly double,
    offices_count bigint, office_count_domestic bigint, office_count_foreign bigint,
    office_count_us_territories bigint,
    established_date date, last_structural_change date, effective_date date,
    end_effective_date date, report_date date, reporting_period_end_date date,
    last_updated date, run_date date
""")
