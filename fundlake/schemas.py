"""Declared schemas of the curated tables, as DDL that readers and createDataFrame take."""

from __future__ import annotations

FUNDS = (
    "id long NOT NULL, name string NOT NULL, category string, aum_euro_bn double, equity_allocation_pct double, equity_strategy_notes string, last_report_year int, website string, data_source string, "
    "dnb_beleids_dgr double, dnb_rente_afdekking_pct double, dnb_zakelijke_waarden_pct double, wtp_transitie_datum string, wtp_contract_type string, wtp_invaren string, wtp_deelnemers_k double, status string, "
    "fixed_income_pct double, real_estate_pct double, alternatives_pct double, vermogensbeheerkosten_pct double, transactiekosten_pct double, sfdr_article int, eu_taxonomy_pct double, "
    "dekkingsgraad_pct double, maanddekkingsgraad_pct double, beleidsdekkingsgraad_pct double, vereiste_dekkingsgraad_pct double, "
    "toeslag_actieven_2025_pct double, toeslag_gewezen_2025_pct double, toeslag_actieven_2026_pct double, toeslag_gewezen_2026_pct double, "
    "deelnemers_actief long, deelnemers_slapers long, deelnemers_gepensioneerd long, deelnemers_totaal long, uitvoeringskosten_miljoenen double, uitvoeringskosten_per_deelnemer double, "
    "vermogensbeheerkosten string, transactiekosten string, beleggingsmix string, benchmarks string, downside_protection string, uitvoerder string, fiduciair_beheerder string, intern_beheer string, "
    "performance_fee_miljoenen double, annual_report_year int, annual_report_downloaded boolean, transitieplan_downloaded boolean, transitieplan_url string"
)
EQUITY_STRATEGIES = "fund_id long, region string, weight_pct double"
EQUITY_STRATEGY = "id long, fund_id long, allocation_pct double, management_style string, factor_investing string, esg_focus string, geographic_allocation string, explicit_geographic_weights string"
EQUITY_ALLOCATIONS = "fund_id long, allocation_pct double, source_file string"
HISTORICAL_METRICS = "id long, fund_id long, year int, beleggingsrendement_pct double, economische_dekkingsgraad_pct double, nominale_dekkingsgraad_pct double, beleidsdekkingsgraad_pct double, reele_dekkingsgraad_pct double, indexatieverlening_pct double, cpi_pct double"
ESG_METRICS = "fund_id long, co2_reduction_goal string, esg_exclusions string, sfdr_classification string"
SCRAPED_DOCUMENTS = "id long, fund_id long, url string, title string, doc_type string, discovered_at timestamp"
NEWS = "id long, fund_id long, published_date string, title string, url string, content string"
PORTFOLIO_FUNDS = "fund_id long, fund_name string"
PEOPLE = "fund_id long, name string, role string, source_url string"
TABLES = {
    "funds": FUNDS,
    "equity_strategies": EQUITY_STRATEGIES,
    "equity_strategy": EQUITY_STRATEGY,
    "equity_allocations_extracted": EQUITY_ALLOCATIONS,
    "historical_metrics": HISTORICAL_METRICS,
    "fund_esg_metrics": ESG_METRICS,
    "scraped_documents": SCRAPED_DOCUMENTS,
    "news_articles": NEWS,
    "equity_portfolio_funds": PORTFOLIO_FUNDS,
    "fund_people": PEOPLE,
}
