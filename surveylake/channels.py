"""The five survey channels as data: which column plays which role in each."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CompanyNames:
    """Spellings of the surveyed company inside column names.

    Some curated columns carry the company's name. It is a deployment setting:
    pass the spellings your tables use.
    """

    value: str = "company"   # q3_csat_with_<value>, q3_csat_with_<value>_value
    full: str = "company"    # ..._experience_with_<full>, ..._receive_from_<full>
    mixed: str = "company"   # sms transactional: ..._receive_from_<mixed>
    joined: str = "company"  # relational: ..._overall_with_<joined>


@dataclass(frozen=True)
class Score:
    target: str                  # normalized double column
    source: str                  # raw column
    leading_number: bool = False  # raw value reads like "5 - Very Satisfied"


@dataclass(frozen=True)
class Channel:
    name: str
    survey_type: str                         # label in the removed-records report
    tracker_prefix: str                      # prefix of the run-tracker columns
    scores: tuple[Score, Score, Score]
    score_questions: tuple[str, str, str]    # question-text aliases of the three scores
    text_questions: tuple[tuple[str, str], ...]  # (alias, raw text column)
    comment_columns: tuple[str, str]         # survey language first
    campaign_filter: bool = False
    key_dedup: bool = False                  # full-key de-duplication instead of by comment
    model_family: str = "default"
    event_date_column: str = "event_date"    # date column of the text stage
    language_column: str = "survey_language"

    @property
    def text_column(self) -> str:
        """The text stage reads the columns in the opposite order."""
        return self.comment_columns[1]

    @property
    def fallback_text_column(self) -> str:
        return self.comment_columns[0]

    @property
    def score_columns(self) -> tuple[str, str, str]:
        return tuple(s.target for s in self.scores)


# Column names of the curated and final tables.
_SATISFACTION = "how_would_you_rate_your_overall_satisfaction_with_this_transaction"
_VISIT_EFFORT = (
    "how_would_you_rate_your_satisfaction_with_the_level_of_effort_required"
    "_to_complete_your_transaction_during_this_visit"
)
_SCORE_REASON = "please_provide_the_reason_for_the_satisfaction_score_you_just_gave"
_VISIT_REASON = "enter_the_reasons_for_this_myaccount_visit"


def channel_specs(company: CompanyNames = CompanyNames()) -> dict[str, Channel]:
    """All channels by name, in processing order."""
    ivr = Channel(
        name="ivr",
        survey_type="IVR",
        tracker_prefix="ivr",
        scores=(
            Score("q1_csat_with_ivr", "q1_csat_with_ivr_value"),
            Score("q2_ease_with_ivr", "q2_ease_with_ivr_value"),
            Score(f"q3_csat_with_{company.value}", f"q3_csat_with_{company.value}_value"),
        ),
        score_questions=(
            _SATISFACTION,
            "how_would_you_rate_the_ease_of_your_transaction",
            "how_would_you_rate_your_overall_satisfaction",
        ),
        text_questions=(
            ("was_this_the_first_time_you_called_to_resolve_this_issue", "q4_first_call_resolution"),
            (
                "do_you_have_additional_feedback_on_how_could_we_improve_your_overall"
                f"_experience_with_{company.full}",
                "q5_overall_exp_comment",
            ),
        ),
        comment_columns=("q5_overall_exp_comment_in_survey_language", "q5_overall_exp_comment"),
        campaign_filter=True,
        key_dedup=True,
        language_column="language",
    )
    sms_transactional = Channel(
        name="sms_transactional",
        survey_type="TXN",
        tracker_prefix="sms_web_transactional",
        scores=(
            Score("q1_satisfaction_value", "q1_satisfaction_value_sms"),
            Score("q2_effort_value", "q2_effort_value_sms"),
            Score("q3_overall_satisfaction", "q3_overall_satisfaction_value_sms"),
        ),
        score_questions=(
            _SATISFACTION,
            _VISIT_EFFORT,
            f"how_would_you_rate_your_overall_satisfaction_with_the_service_you_receive_from_{company.mixed}",
        ),
        text_questions=(
            ("do_you_have_additional_feedback_regarding_your_transaction_this_visit", "q4_comment_sms"),
        ),
        comment_columns=("q4_comment_in_survey_language_sms", "q4_comment_sms"),
        model_family="sms_web",
        event_date_column="survey_event_date",
    )
    sms_relational = Channel(
        name="sms_relational",
        survey_type="REL",
        tracker_prefix="sms_web_relational",
        scores=(
            Score("q2_satisfaction_value", "q2_satisfaction_value_sms"),
            Score("q3_effort_value", "q3_effort_value_sms"),
            Score("q4_overall_satisfaction", "q4_overall_satisfaction_value_sms"),
        ),
        score_questions=(
            _SATISFACTION,
            _VISIT_EFFORT,
            f"how_would_you_rate_your_overall_satisfaction_overall_with_{company.joined}",
        ),
        text_questions=((_VISIT_REASON, "q1_reasons_sms"), (_SCORE_REASON, "q5_comment_sms")),
        comment_columns=("q5_comment_in_survey_language_sms", "q5_comment_sms"),
        model_family="sms_web",
        event_date_column="survey_event_date",
    )
    api_transactional = Channel(
        name="api_transactional",
        survey_type="API_TXN",
        tracker_prefix="api_web_transactional",
        scores=(
            Score("q1_satisfaction_value", "q1_satisfaction_value"),
            Score("q2_effort_value", "q2_effort_value"),
            Score("q3_overall_satisfaction", "q3_overall_satisfaction_value"),
        ),
        score_questions=(
            "how_would_you_rate_your_overall_satisfaction_with_this_visit",
            _VISIT_EFFORT,
            f"how_would_you_rate_your_overall_satisfaction_with_the_service_you_receive_from_{company.full}",
        ),
        text_questions=(
            ("do_you_have_additional_feedback_regarding_your_transaction_for_this_visit", "q4_feedback_comment"),
        ),
        comment_columns=("q4_feedback_comment_in_survey_language", "q4_feedback_comment"),
    )
    api_relational = Channel(
        name="api_relational",
        survey_type="API_REL",
        tracker_prefix="api_web_relational",
        scores=(
            Score("q2_satisfaction_value", "web_relational_survey_q2_satisfaction", leading_number=True),
            Score("q3_effort_value", "q3_effort_value"),
            Score("q4_overall_satisfaction", "q4_overall_satisfaction_value"),
        ),
        score_questions=(
            _SATISFACTION,
            _VISIT_EFFORT,
            f"how_would_you_rate_your_overall_satisfaction_overall_with_{company.joined}",
        ),
        text_questions=(
            (_VISIT_REASON, "q1_reasons_in_survey_language"),
            (_SCORE_REASON, "q5_feedback_comment"),
        ),
        comment_columns=("q5_feedback_comment_in_survey_language", "q5_feedback_comment"),
    )
    return {c.name: c for c in (ivr, sms_transactional, sms_relational, api_transactional, api_relational)}


CHANNEL_NAMES = tuple(channel_specs())

# Order in which available channels are handed to the text stage; ivr is last and always runs.
SCORING_ORDER = ("sms_relational", "sms_transactional", "api_transactional", "api_relational", "ivr")

# Channels scored by the sms/web models.
SMS_WEB_CHANNELS = tuple(n for n, c in channel_specs().items() if c.model_family == "sms_web")

# The key of the full-key de-duplication.
RESPONSE_KEYS = (
    "response_received_date",
    "cas_account_number",
    "survey_id",
    "survey_name",
    "case_type",
    "event_ts",
    "queue_time",
)

# Columns of the removed-records report taken from the response, where present.
REMOVED_COLUMNS = ("response_received_date", "cas_account_number", "customer_account_number", "contact_record_id")


def parse_channel_list(requested: str) -> tuple[str, ...]:
    """Channels named in a comma list.

    Unknown names are ignored; ``all``, or a list without a known name, selects
    every channel.
    """
    wanted = {part.strip() for part in requested.lower().split(",")}
    chosen = tuple(name for name in CHANNEL_NAMES if name in wanted)
    return chosen or CHANNEL_NAMES
