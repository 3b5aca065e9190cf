"""Sources: tables, landed inventory pages, landed monitoring responses, lists."""
