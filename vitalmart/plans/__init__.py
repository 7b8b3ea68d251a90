"""Table plans: cleaned layer, code lookups, star schema, CMS mart and reports."""
