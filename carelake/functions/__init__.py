"""Column rules: names in, Columns out; nothing here touches a DataFrame's rows."""
