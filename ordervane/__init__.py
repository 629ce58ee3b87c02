"""Order analytics on Spark: CRM and ERP rows in, customer KPIs out."""
