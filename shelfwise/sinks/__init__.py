"""Writers: tables, processed files, forecast tables, dated report sets, views."""
