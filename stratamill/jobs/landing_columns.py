"""The columns that the sources of the landing feeds have, in their order."""

# Payment messages: all four tables begin with these columns.
PAYMENT_COMMON = """
msg_key msg_type trx_type err_status sd_time o_ci_id response_code serial_no trx_date input_type tad_id e_sign r_ci_id
o_indirect_id r_indirect_id balance_time currency amount sd_name sd_addr sd_accnt rv_name rv_addr rv_accnt content opert1 opert2
trx_status trx_file_name file_core relation_no mac process sd_identify rv_identify authorized fee_ci_id fee_flag reference
tax_code sd_code rv_code ex_e_sign msg_reason orig_id confirm_id appr_id create_time appr_time gtw_flag appr_in_time appr_in_id
content_ex err_msg sd_id_no sd_issue_date sd_issuer rv_id_no rv_issue_date rv_issuer option1 option2 option3 spare cus_type
exchange_rate acc_num
"""
# What each table goes on with; the business date is made of the moment of creation.
PAYMENT_REST = {
    "tbltransactionmsg_org_fcout": """
channel status insert_time standard_time sign_time transfer_time exp_msg client_ip msg_id routing_id is_sbco trx_type_org
""",
    "tbltransactionmsg_org_fcin": """
insert_time process_time update_time client_ip status trx_date_org o_ci_id_org serial_no_org change_time change_client_ip
change_appr_id
""",
    "tbltransactionmsg_org_in": """
insert_time process_time update_time client_ip status trx_date_org o_ci_id_org serial_no_org change_time change_client_ip
change_appr_id
""",
    "tbltransactionmsg_org_out": """
channel status insert_time standard_time sign_time transfer_time exp_msg client_ip msg_id routing_id is_sbco trx_type_org
routing_id_ext
""",
}
# Net interest of cards.
CARD_INTEREST = {
    "nii_card_rpt": """
card_id cif_no cust_name acct_no branch_cd_acct branch_cd_crdid man_user_ad card_no card_name limit_amt card_bal_dly
mtd_avg_card_bal ytd_avg_card_bal intrst_amt ftp_rate nii intrst_amt_dly ftp_rate_dly nii_incas_dly mtd_intrst_amt mtd_ftp_rate
mtd_nii_incas ytd_nii_incas cob_dt updtd_dtm
""",
    "nii_card_rpt_all_dly": """
card_id cif_no cust_name acct_no branch_cd_acct branch_cd_crdid man_user_ad card_no card_name limit_amt card_bal mtd_card_bal
ytd_card_bal intrst_amt_dly ftp_rate_dly nii_incas_dly mtd_intrst_amt mtd_ftp_rate mtd_nii_incas ytd_nii_incas cob_dt updtd_dtm
""",
    "nii_card_rpt_dly": """
card_id cif_no cust_name acct_no branch_cd_acct branch_cd_crdid man_user_ad card_no card_name limit_amt card_bal cob_dt
updtd_dtm intrst_amt_dly ftp_rate_dly nii_dly
""",
    "nii_card_intrst_incas_dly": "acct_no card_id rate intrst_amt cob_dt updtd_dtm ftp_rate nii",
    "nii_card_rpt_summy": "acct_no branch_cd_acct dept_cd_acct card_bal prev_day_card_bal prev_mnth_card_bal cob_dt updtd_dtm",
}
# Management overview.
FINANCE = {
    "bod_overall_report_db": """
cob_dt item_id item_nm heading item_order report_type plan_flag plan_value_12m avg_plan_value value adj_value final_value
mtd_value mtd_adj_value mtd_final_value avg_value_m ytd_value ytd_adj_value ytd_final_value avg_value_y prv_day_value
prv_day_adj_value prv_day_final_value prv_mth_value prv_mth_adj_value prv_mth_final_value prv_yr_value prv_yr_adj_value
prv_yr_final_value prv_mth_mtd_value prv_mth_mtd_adj_value prv_mth_mtd_final_value prv_mth_avg_value_m prv_yr_ytd_value
prv_yr_ytd_adj_value prv_yr_ytd_final_value prv_yr_avg_value_y
""",
}
# Customer risk levels.
RISK = "kundnr cust_segments risk_level updtd_by updtd_dtm cob_dt"

# The department dimension as exported.
DEPARTMENTS = """
cob_dt ho_branch ho_branchho_transaction setid unit_id unitid unitname division_id division_name center_id center_name deptid
dept_code deptname area province_city status company setid_location deptid_wfp deptname_wfp
"""
