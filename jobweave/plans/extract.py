"""The feature job: standard records to searchable features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.experience import age_list, experience_list
from ..functions.location import extract_location, location_area, location_province
from ..functions.salary import (
    salary_average,
    salary_bins_from_numbers,
    salary_bins_from_text,
    salary_range_b,
)


def extract_features(df: DataFrame) -> DataFrame:
    """The 24-column feature record.  Salary comes from the text, whatever the record says."""
    priced = df.withColumn("_salary", salary_range_b("salary_text"))
    low, high = F.col("_salary.min"), F.col("_salary.max")
    return priced.select(
        "source",
        F.col("job_title_clean").alias("title"),
        F.col("company_name").alias("company"),
        F.col("location_clean").alias("location_raw"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        "job_type",
        "job_level",
        F.col("experience").alias("experience_avg"),
        "industry",
        "skills",
        F.col("job_description").alias("description"),
        "salary_text",
        "experience_text",
        vocab.extract_programming_languages("job_description", "skills").alias("JobLanguages"),
        vocab.extract_languages("skills").alias("Languages"),
        vocab.extract_design_patterns("job_description", "skills").alias("DesignPatterns"),
        vocab.extract_knowledge("job_description", "skills").alias("Knowledges"),
        vocab.extract_education("education").alias("Education"),
        vocab.extract_job_type("industry").alias("JobSummary"),
        experience_list("experience_text").alias("Experience"),
        salary_average(low, high).alias("salary_avg"),
        location_area("location_clean").alias("location_area"),
        location_province("location_clean").alias("province"),
    )


def extract_raw_features(df: DataFrame, contact: bool = False) -> DataFrame:
    """Features of a raw record with Vietnamese column names.

    Contact details are personal data and stay out unless asked for.
    """
    requirements, description = F.col("`kĩ năng yêu cầu`"), F.col("`mô tả công việc`")
    features = [
        F.col("`tên công việc`").alias("JobName"),
        F.col("`tên công ty`").alias("CompanyName"),
        extract_location(F.col("`địa điểm`")).alias("Location"),
        experience_list(F.col("`kinh nghiệm`")).alias("Experience"),
        F.col("`loại công việc`").alias("JobType"),
        F.col("`cấp bậc`").alias("Level"),
        vocab.extract_education(requirements).alias("Education"),
        F.col("`giới tính`").alias("Sex"),
        age_list(F.col("`tuổi`")).alias("Old"),
        vocab.extract_frameworks(description, requirements).alias("FrameworkPlattforms"),
        vocab.extract_programming_languages(description, requirements).alias("JobLanguages"),
        vocab.extract_languages(requirements).alias("Languages"),
        vocab.extract_design_patterns(description, requirements).alias("DesignPatterns"),
        vocab.extract_knowledge(description, requirements).alias("Knowledges"),
        salary_bins_from_text(F.col("`mức lương`")).alias("Salaries"),
        vocab.extract_job_type(F.col("`ngành nghề`")).alias("JobSummary"),
    ]
    if contact:
        features.append(F.col("`thông tin liên hệ`").alias("Contact"))
    return df.select(*features).withColumn("Knowledge", vocab.grouped_knowledge("Knowledges"))


def extract_typed_features(df: DataFrame) -> DataFrame:
    """Features of the typed record, whose skills are already a list."""
    skills = F.array_join("skills", ", ")
    return df.select(
        F.col("job_title").alias("JobName"),
        F.col("company_name").alias("CompanyName"),
        extract_location("location").alias("Location"),
        F.col("experience_years").alias("Experience"),
        F.col("job_type").alias("JobType"),
        vocab.extract_education("education_level").alias("Education"),
        vocab.extract_frameworks("job_description", skills).alias("FrameworkPlattforms"),
        vocab.extract_programming_languages("job_description", skills).alias("JobLanguages"),
        vocab.extract_languages(skills).alias("Languages"),
        vocab.extract_design_patterns("job_description", skills).alias("DesignPatterns"),
        vocab.extract_knowledge("job_description", skills).alias("Knowledges"),
        salary_bins_from_numbers(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")).alias("Salaries"),
        vocab.extract_job_type("industry").alias("JobSummary"),
    )
