"""Ready-made Spark DataFrame jobs: sources, log reports, relational building
blocks, entity resolution over text, and rating analysis."""
