"""claimwise: claims-data extract, enrichment and analytics as Spark DataFrame programs.

Sub-packages
------------
functions   Column -> Column helpers (cleaning, padding, quarters, mappings, hashing)
operators   DataFrame -> DataFrame operators (extract, row filters, enrichment,
            id decode, quarterly statistics, person fingerprint, comorbidity score,
            data-quality rules)
sources     readers and writers (delimited slices, catalogue files, value lists,
            slice layout, merge, versioned column update)
plans       stand-in frames over the driver tables and the registered queries
streaming   the export chain on a streaming source
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
